"""Plan guards over every registered query: no all-pairs joins, no Python in
the hot path, and the skew-safe shapes the operators promise."""

import pytest

import __spark_entry__ as E
from small_tables import SF_SMALL
from tidewater.plans import registry

# physical operators that pair rows without a key or leave the JVM row by row
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_no_pairwise_join_or_python_udf(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op}"


def test_running_stock_is_sliced_by_the_row_alone(spark):
    plan = _plan(E.queries()["inventory_running"](spark, SF_SMALL))
    assert "_slice" in plan and "rangepartitioning" not in plan


def _final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_paged_export_reads_its_pages_and_no_events(spark):
    plan = _final_plan(E.queries()["unpage_export"](spark, SF_SMALL))
    final = plan.split("Initial Plan")[0]
    # the landed pages: once for the stops, once for the bodies
    assert final.count("FileScan parquet") == 2 and "events.parquet" not in final
    assert final.count("Exchange hashpartitioning") <= 2


def test_quantile_sketches_are_not_grouped_by_customer(spark):
    plan = _plan(E.queries()["order_metrics"](spark, SF_SMALL))
    for line in plan.splitlines():
        assert not ("percentile_approx" in line and "keys=[" in line and "customer_id" in line.split("functions=")[0]), line


def test_dedup_and_latest_aggregate_before_the_shuffle(spark):
    plan = _plan(E.queries()["orders_latest"](spark, SF_SMALL))
    # map-side (partial) aggregation below each exchange on the grouping keys
    assert plan.count("Exchange hashpartitioning(event_id") == 1
    assert plan.count("Exchange hashpartitioning(order_id") == 1
    assert "partial_min" in plan and "partial_max" in plan
