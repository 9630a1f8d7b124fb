"""Every registered query against its DuckDB oracle on the small test tables."""

import pytest

import __spark_entry__ as E
from oracle_check import compare, duck_conn
from small_tables import SF_SMALL

from tidewater.plans import registry

NAMES = sorted(registry.QUERIES)  # the text operators have their own tests


@pytest.fixture(scope="module")
def con():
    return duck_conn(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(registry.ORACLES) == set(registry.QUERIES)
    assert set(registry.QUERIES) <= set(E.queries()) and set(registry.ORACLES) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert "order_id" in df.columns and df.count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, E.queries()[name], E.oracle_sql().get(name), SF_SMALL)
    assert r["ok"], r
