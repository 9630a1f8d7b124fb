import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from tidewater.session import build_session
    s = build_session("local[4]", shuffle_partitions=4, app="tidewater-tests")
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from tidewater.session import scratch_path
    return lambda label="t": scratch_path(spark, label)
