"""Latest-per-order picks, the order timeline, running stock and the salted join."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.operators import inventory, salted, timeline
from tidewater.schemas import INVENTORY, ORDERS, PAYMENTS, SHIPPING, schema_for
from tidewater.sources.readers import normalise_timestamps

T = dt.datetime(2024, 1, 15, 10, 0, 0)


def df_of(spark, service, rows):
    return normalise_timestamps(spark.createDataFrame(rows, schema_for(service)))


def test_latest_ignores_cancelled_and_breaks_ties_by_event_id(spark):
    orders = df_of(spark, ORDERS, [
        ("e1", "o1", "c", "ORDER_CREATED", "pending", 10.0, "BRL", 1, T, "1"),
        ("e3", "o1", "c", "ORDER_UPDATED", "paid", 10.0, "BRL", 1, T + dt.timedelta(hours=1), "1"),
        ("e2", "o1", "c", "ORDER_UPDATED", "other", 10.0, "BRL", 1, T + dt.timedelta(hours=1), "1"),
        ("e4", "o1", "c", "ORDER_CANCELLED", "cancelled", 10.0, "BRL", 1, T + dt.timedelta(hours=9), "1"),
    ])
    r = timeline.orders_latest(orders).first()
    assert r.order_status == "paid"


def test_timeline_derived_columns(spark):
    orders = df_of(spark, ORDERS, [("e1", "o1", "c", "ORDER_CREATED", "pending", 10.0, "BRL", 1, T, "1"),
                                   ("e2", "o2", "c", "ORDER_CREATED", "pending", 20.0, "BRL", 1, T, "1")])
    pays = df_of(spark, PAYMENTS, [("p", "p1", "o1", "PAYMENT_PROCESSED", 10.005, "BRL", "pix", "s", "approved",
                                    T, "1")])
    ships = df_of(spark, SHIPPING, [("s", "s1", "o1", "SHIPMENT_DISPATCHED", "x", "t", "in_transit",
                                     T - dt.timedelta(hours=2, seconds=30), "1")])
    rows = {r.order_id: r for r in timeline.order_timeline(orders, pays, ships).collect()}
    assert rows["o1"].payment_match is True and rows["o2"].payment_match is None
    assert rows["o1"].order_lifecycle_hours == -(2 * 3600 + 30) / 3600.0
    assert rows["o2"].order_lifecycle_hours is None


def test_timeline_joins_reuse_order_partitioning(spark):
    orders = df_of(spark, ORDERS, [("e1", "o1", "c", "ORDER_CREATED", "pending", 10.0, "BRL", 1, T, "1")])
    pays = df_of(spark, PAYMENTS, [("p", "p1", "o1", "X", 1.0, "BRL", "pix", "s", "approved", T, "1")])
    ships = df_of(spark, SHIPPING, [("s", "s1", "o1", "X", "x", "t", "in_transit", T, "1")])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = timeline.order_timeline(orders, pays, ships)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # three aggregations shuffle on order_id; the joins add no exchange of their own
    assert plan.count("Exchange hashpartitioning(order_id") == 3


def _inventory_rows(n=4000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        sku = "HOT" if i % 3 else f"S{rnd.randint(0, 5)}"
        ts = None if i == 17 else T + dt.timedelta(minutes=rnd.randint(0, 600) * 7)
        rows.append((f"e{i}", sku, f"W{rnd.randint(1, 2)}", "STOCK_UPDATED", rnd.randint(-30, 40), None, ts, "1"))
    return rows


def _assert_equals_range_window(inv, got):
    w = Window.partitionBy("sku", "warehouse_id").orderBy("timestamp")
    want = inv.withColumn("running_quantity", F.sum("quantity_delta").over(w)) \
              .withColumn("stockout_risk", inventory.stockout_risk())
    assert got.select(*want.columns).exceptAll(want).count() == 0
    assert want.exceptAll(got.select(*want.columns)).count() == 0


def test_running_stock_equals_range_window(spark):
    inv = df_of(spark, INVENTORY, _inventory_rows())
    # many slices: the hot key is cut at every minute
    _assert_equals_range_window(inv, inventory.inventory_running(inv, width="minute"))
    _assert_equals_range_window(inv, inventory.inventory_running(inv))


def test_running_stock_hot_key_within_one_hour(spark):
    # a third of the rows on one key, all inside one minute, and NULL deltas
    rows = [(f"h{i}", "HOT", "W", "STOCK_UPDATED", None if i % 50 == 0 else (i % 7) - 3, None,
             T + dt.timedelta(microseconds=i * 13 % 9000), "1") for i in range(3000)]
    rows += [(f"c{i}", f"S{i % 40}", "W", "STOCK_UPDATED", i % 5, None, T + dt.timedelta(seconds=i), "1")
             for i in range(6000)]
    rows += [("n0", "N", "W", "STOCK_UPDATED", None, None, T, "1"), ("n1", "N", "W", "STOCK_UPDATED", 4, None,
                                                                       T + dt.timedelta(seconds=1), "1")]
    inv = df_of(spark, INVENTORY, rows)
    _assert_equals_range_window(inv, inventory.inventory_running(inv, width="second"))


def test_running_stock_ties_share_total(spark):
    rows = [(f"e{i}", "S", "W", "STOCK_UPDATED", 5, None, T, "1") for i in range(50)]
    out = inventory.inventory_running(df_of(spark, INVENTORY, rows)).select("running_quantity").distinct().collect()
    assert [r.running_quantity for r in out] == [250]


def test_salted_join_equals_plain_join(spark):
    left = spark.createDataFrame([(f"e{i}", "HOT" if i % 2 else f"k{i % 50}") for i in range(5000)] + [("n", None)],
                                 "event_id string, k string")
    right = spark.createDataFrame([("HOT", 1), ("k2", 2), ("zz", 3)], "k string, v int")
    got = salted.salted_join(left, right, "k", "event_id", "left", rows_per_salt=100)
    want = left.join(right, "k", "left")
    assert got.count() == want.count() == 5001
    assert got.select(*want.columns).exceptAll(want).count() == 0


def test_latest_on_a_hot_order_equals_row_number_pick(spark):
    rows = [(f"e{i:05d}", "HOT" if i % 3 == 0 else f"o{i % 200}", "c", "ORDER_UPDATED", f"s{i % 7}", float(i), "BRL", 1,
             T + dt.timedelta(minutes=i % 500), "1") for i in range(6000)]
    orders = df_of(spark, ORDERS, rows).repartition(7)
    got = timeline.orders_latest(orders)
    w = Window.partitionBy("order_id").orderBy(F.col("timestamp").desc(), F.col("event_id").desc())
    want = (orders.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1")
            .select("order_id", "customer_id", F.col("status").alias("order_status"), "total_amount", "currency",
                    "items_count", F.col("timestamp").alias("order_updated_at")))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert got.count() == 201


def test_running_stock_null_keys_form_their_own_series(spark):
    rows = [(f"e{i}", None if i % 4 == 0 else "S", None if i % 5 == 0 else "W", "STOCK_UPDATED", (i % 9) - 4, None,
             T + dt.timedelta(seconds=i % 37), "1") for i in range(800)]
    inv = df_of(spark, INVENTORY, rows)
    _assert_equals_range_window(inv, inventory.inventory_running(inv, width="second"))
