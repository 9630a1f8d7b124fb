"""Where the tests find the small test tables."""

import os

SF_SMALL = os.environ.get("TIDEWATER_TEST_SF", "/root/testdata/sf0.001")
