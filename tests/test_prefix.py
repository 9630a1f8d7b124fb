"""Running sums over many slices: the same under any physical plan."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.operators import inventory, scope, salted
from tidewater.sources.export import position_in_group


@pytest.mark.parametrize("coalesce", ["true", "false"])
@pytest.mark.parametrize("reuse", ["true", "false"])
def test_positions_and_totals_do_not_depend_on_the_plan(spark, coalesce, reuse):
    n = 1_100_000
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": coalesce, "spark.sql.exchange.reuse": reuse}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 11)).alias("k"),
            ((F.col("id") * 7919) % 1_100_003).alias("eid"), F.concat(F.lit("payload "), F.col("id")).alias("payload"))
        got = position_in_group(rows, ["k"], "eid")
        want = F.row_number().over(Window.partitionBy("k").orderBy("eid"))
        assert got.withColumn("want", want).where("want != _pos or _pos is null").count() == 0
        assert got.count() == n

        stock = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("S"), F.col("id") % 7)).alias("sku"),
            F.lit("W").alias("warehouse_id"), (F.col("id") % 13 - 6).alias("quantity_delta"), F.col("id").alias("event_id"),
            F.timestamp_seconds((F.col("id") * 7919) % 900_000).cast("timestamp_ntz").alias("timestamp"))
        w = Window.partitionBy("sku", "warehouse_id").orderBy("timestamp")
        out = inventory.inventory_running(stock).withColumn("want", F.sum("quantity_delta").over(w))
        assert out.where("not (want <=> running_quantity)").count() == 0
    finally:
        for k in conf:
            spark.conf.unset(k)


def test_priority_scope_takes_any_priorities(spark):
    events = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("new", 4), (None, 5)], "_service string, v int")
    services = spark.createDataFrame([("a", "high"), ("b", "medium"), ("c", None), ("a", "high")], "name string, priority string")
    pick = lambda *p: sorted(r.v for r in scope.priority_scope(events, services, p).collect())
    assert pick("high") == [1]
    assert pick("medium") == [2, 3, 4, 5]  # no priority, not listed and no name count as medium
    assert pick("critical") == [] and pick("high", "medium") == [1, 2, 3, 4, 5]


def test_salts_follow_the_rows_of_each_key(spark):
    left = spark.range(3000).select(F.when(F.col("id") < 2000, "h").when(F.col("id") < 2500, "g").otherwise("x").alias("k"), "id")
    salts = {r.k: r._salts for r in salted.key_salts(left, "k", 500).collect()}
    assert salts == {"h": 4}
    right = spark.createDataFrame([("h", 1), ("h", 2), ("g", 3)], "k string, v int")
    for how in ("left", "inner"):
        got, want = salted.salted_join(left, right, "k", "id", how, rows_per_salt=300), left.join(right, "k", how)
        assert got.exceptAll(want.select(got.columns)).count() == 0 and got.count() == want.count()
