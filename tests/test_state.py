"""What lasts beyond a run: the log by hour, the dedup ledger, incremental KPIs, sketches, dense series."""

import collections
import datetime as dt
import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from small_tables import SF_SMALL
from tidewater.operators import calendar, dedup, inventory, metrics, recovery, salted, sketches, timeline
from tidewater.operators.incremental import SERVICES, KpiState
from tidewater.operators.ledger import Ledger, dedup_run
from tidewater.plans.queries import _in
from tidewater.plans.queries_state import _earlier_state
from tidewater.schemas import ORDERS, PAYMENTS
from tidewater.sinks.bucketed import BucketedTables
from tidewater.sinks.event_log import read_event_log, write_event_log
from tidewater.streaming.keyed import LatestTable, StockStream

T0 = dt.datetime(2024, 1, 15)


def as_rows(df):
    cols = sorted(df.columns)
    rounded = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    return collections.Counter(tuple(r[c] for c in cols) for r in df.select(*rounded).collect())


# ------------------------------------------------------------ log by hour

def _log(spark, hours):
    rows = [(f"e{h}_{n}", "X", T0 + dt.timedelta(hours=h, minutes=7 * n), s) for h in range(hours) for n in range(3) for s in (ORDERS, PAYMENTS)]
    return spark.createDataFrame(rows + [("none", "X", None, ORDERS)], "event_id string, event_type string, timestamp timestamp_ntz, _service string")


def _files_read(df):
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().apply("numFiles").value()


def test_recovery_reads_the_hours_of_its_window_alone(spark, scratch):
    read = []
    for hours in (30, 90):
        events, path = _log(spark, hours), scratch("log")
        write_event_log(events, path)
        log = read_event_log(spark, path, events.schema)
        assert log.count() == events.count()
        part = recovery.recovery_slice(log, (PAYMENTS,), 6, "2024-01-15 20:10:00", strict=True)
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert "_hour" in plan.split("PartitionFilters: [")[1].split("]")[0]
        want = recovery.recovery_slice(events, (PAYMENTS,), 6, "2024-01-15 20:10:00")
        assert as_rows(part.select(events.columns)) == as_rows(want) and want.count() > 10
        read.append(_files_read(part))
    assert read[0] == read[1] == 7  # 14 h to 20 h, one file each


def test_a_rerun_replaces_its_hours_only(spark, scratch):
    events, path = _log(spark, 24), scratch("log")
    write_event_log(events, path)
    again = events.where((F.col("_service") == ORDERS) & (F.hour("timestamp") == 3)).withColumn("event_type", F.lit("Y"))
    write_event_log(again, path, partial=True)
    log = read_event_log(spark, path, events.schema)
    assert log.count() == events.count() and log.where("event_type = 'Y'").count() == 3


# ------------------------------------------------------------ ledger

def _batches(spark, seed=3):
    rnd = random.Random(seed)
    events = [(f"id{k}" if k % 50 else None, T0 + dt.timedelta(minutes=k), f"v{k}") for k in range(1500)]
    batches = [events[a:b] + rnd.sample(events[a:b], 200) for a, b in ((0, 700), (400, 1100), (900, 1500))]
    return [spark.createDataFrame(b, "event_id string, timestamp timestamp_ntz, v string") for b in batches]


@pytest.mark.parametrize("buckets, words", [(16, 1 << 16), (2, 3)])  # a roomy filter, and one in which nearly every id hits
def test_three_runs_equal_one_dedup_of_their_union(spark, scratch, buckets, words):
    batches, root = _batches(spark), scratch("ledger")
    ledger = Ledger(spark, f"{root}/ledger", buckets, words)
    for n, b in enumerate(batches):
        dedup_run(b, ledger, f"run {n}: é/1", f"{root}/out")
    out = lambda: spark.read.schema(batches[0].schema).parquet(f"{root}/out").drop("_run")
    union = batches[0].union(batches[1]).union(batches[2])
    assert as_rows(out()) == as_rows(dedup.dedup_events(union))
    recorded = as_rows(ledger.ids())
    again = dedup_run(batches[1], ledger, "run 1: é/1", f"{root}/out")  # emits the same, adds nothing
    assert as_rows(out()) == as_rows(dedup.dedup_events(union)) and as_rows(ledger.ids()) == recorded
    assert again.where("event_id IS NOT NULL").count() == 392  # and eight without an id
    late = dedup_run(batches[0], ledger, "run 9", f"{root}/late")  # all was emitted before
    assert late.where("event_id IS NOT NULL").count() == 0


def test_merged_filters_hide_nothing(spark, scratch):
    batches, root = _batches(spark, 4), scratch("ledger")
    ledger = Ledger(spark, f"{root}/ledger", 8, 1 << 12)
    for n, b in enumerate(batches[:2]):
        dedup_run(b, ledger, f"r{n}", f"{root}/out")
    ledger.compact_filters(["r0", "r1"])
    ledger.compact_filters([])
    assert ledger.filters().select("_run").distinct().count() == 1
    first = dedup_run(batches[0], ledger, "r0", f"{root}/again").where("event_id IS NOT NULL").count()
    assert first == 686  # a rerun after the merge emits its own again
    dedup_run(batches[2], ledger, "r2", f"{root}/out")
    union = batches[0].union(batches[1]).union(batches[2])
    assert as_rows(spark.read.schema(batches[0].schema).parquet(f"{root}/out").drop("_run")) == as_rows(dedup.dedup_events(union))


def test_rows_of_a_run_are_shuffled_once(spark, scratch):
    batches, root = _batches(spark), scratch("ledger")
    ledger = Ledger(spark, f"{root}/ledger", 64, 1 << 20)
    dedup_run(batches[0], ledger, "r0", f"{root}/out")
    staged = scratch("t")
    left = ledger.unseen(dedup.first_copies(batches[1]).hint("merge"), "r1", staged)
    assert as_rows(left) == as_rows(dedup.dedup_events(batches[1]).where("substr(event_id, 3) >= 700"))
    plan = left._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    rows = [x for x in plan.split("\n") if "Exchange hashpartitioning(event_id" in x]
    assert len(rows) == 1 and "RoundRobin" not in plan and "REBALANCE" not in plan
    assert spark.read.parquet(staged).columns == ["_bucket", "_id"]  # no rows are staged


def test_ids_of_earlier_runs_are_read_for_hits_alone(spark, scratch, monkeypatch):
    batches, root = _batches(spark), scratch("ledger")
    ledger, asked = Ledger(spark, f"{root}/ledger", 64, 1 << 20), []
    seen = Ledger._seen
    monkeypatch.setattr(Ledger, "_seen", lambda self, hits, run, buckets: asked.append(buckets) or seen(self, hits, run, buckets))
    dedup_run(batches[0], ledger, "r0", f"{root}/out")
    fresh = spark.createDataFrame([(f"new{k}", T0, "v") for k in range(300)], batches[0].schema)
    assert ledger.unseen(fresh, "r1", scratch("t")).count() == 300 and not asked
    one = fresh.union(batches[0].where("event_id = 'id7'").limit(1))
    left = ledger.unseen(one, "r1", scratch("t"))
    assert left.count() == 300 and len(asked) == 1 and len(asked[0]) == 1
    plan = left._jdf.queryExecution().executedPlan().toString()

    assert "_bucket" in plan.split("PartitionFilters: [")[-1] and "Python" not in plan
    assert ledger.unseen(fresh.limit(0), "r1", scratch("t")).count() == 0


# ------------------------------------------------------------ incremental KPIs

def _valid(spark):
    i = _in(spark, SF_SMALL)
    return {s: spark.createDataFrame(i.valid(s).collect(), i.valid(s).schema) for s in SERVICES}


def _files(root, table):
    return {p: os.stat(p).st_ino for p in glob.glob(f"{root.removeprefix('file:')}/{table}/*/*.parquet")}


def test_a_delta_equals_the_full_recomputation(spark, scratch):
    final = _valid(spark)
    before, upserts, deletes = _earlier_state(final)
    root = scratch("kpis")
    state = KpiState(spark, root, buckets=8)
    state.build(before)
    assert as_rows(state.order_metrics()) == as_rows(metrics.order_metrics(timeline.order_timeline(*(before[s] for s in SERVICES))))
    for _ in range(2):  # the second time it changes nothing
        state.apply(upserts, deletes)
        rows = timeline.order_timeline(*(final[s] for s in SERVICES))
        assert as_rows(state.timeline().drop("_part")) == as_rows(rows)
        assert as_rows(state.order_metrics()) == as_rows(metrics.order_metrics(rows))
        whole = metrics.kpi_cells(rows)
        assert as_rows(metrics.payment_funnel(state.cells())) == as_rows(metrics.payment_funnel(whole))
        assert as_rows(metrics.sla_metrics(state.cells())) == as_rows(metrics.sla_metrics(whole))


def test_a_small_delta_touches_little(spark, scratch):
    final, root = _valid(spark), scratch("kpis")
    state = KpiState(spark, root, buckets=32)
    state.build(final)
    one = final[ORDERS].where("event_type = 'ORDER_CREATED'").orderBy("order_id").limit(1)
    was = {t: _files(root, t) for t in ("order_metrics", "timeline", "events/orders-service")}
    # a later state of one order: it leaves its window
    moved = one.withColumns({"event_id": F.lit("late"), "event_type": F.lit("ORDER_UPDATED"), "timestamp": F.col("timestamp") + F.expr("INTERVAL 400 DAYS")})
    said = state.apply({ORDERS: moved}, {})
    assert said == {"orders": 1, "buckets": 1, "parts": 2}
    for table, files in was.items():
        now = _files(root, table)
        assert len(set(files) - set(now)) <= 1 and len(set(now) - set(files)) <= 2, table
    # the order is taken back: the window that it was in alone is gone
    state.apply({}, {s: state.events(s).join(one.select("order_id"), "order_id", "left_semi").select("event_id", "order_id") for s in SERVICES})
    assert state.timeline().where(F.col("_part") >= "2025").count() == 0 and not glob.glob(f"{root.removeprefix('file:')}/order_metrics/_part=2025*")
    assert state.apply({}, {}) == {"orders": 0, "buckets": 0, "parts": 0}


# ------------------------------------------------------------ sketches

def test_merged_quantiles_of_a_large_group_keep_the_rank_error(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/lineitem.parquet").select(
        F.lit("x").alias("order_status"), F.lit("y").alias("currency"), F.col("l_extendedprice").alias("total_amount"),
        F.col("l_orderkey").cast("string").alias("order_id"), F.col("l_orderkey").cast("string").alias("customer_id"), F.lit(1).cast("long").alias("items_count"),
        (F.lit("2024-01-15").cast("timestamp_ntz") + F.make_dt_interval(mins=(F.col("l_linenumber") + F.col("l_partkey")) % 1440)).alias("order_updated_at"))
    day = sketches.roll_up(sketches.kpi_sketches(rows), "day").first()
    amounts = sorted(r[0] for r in rows.select("total_amount").collect())
    n = len(amounts)
    assert n > 500_000 and day.tickets == n
    one = spark.createDataFrame([(day.amounts, day.customers)], "amounts binary, customers binary")
    import bisect
    for share in (0.01, 0.25, 0.5, 0.95, 0.99):
        got = one.select(sketches.quantile("amounts", share)).first()[0]
        low, high = bisect.bisect_left(amounts, got), bisect.bisect_right(amounts, got)
        assert low - sketches.rank_error() * n <= share * n <= high + sketches.rank_error() * n, share
    distinct = rows.select("customer_id").distinct().count()
    assert distinct > 2 ** 16
    assert abs(one.select(F.theta_sketch_estimate("customers")).first()[0] / distinct - 1) < 3 * sketches.distinct_error()


def test_sketches_of_odd_rows(spark):
    rows = spark.createDataFrame([("a", None, None, "o1", None, None, T0), (None, None, 5.0, "o2", "c", 1, T0), ("a", "x", 1.0, "o3", "c", 1, None)],
                                 "order_status string, currency string, total_amount double, order_id string, customer_id string, items_count long, order_updated_at timestamp_ntz")
    out = {r.order_status: r for r in sketches.finished(sketches.kpi_sketches(rows)).collect()}
    assert set(out) == {"a", None} and out["a"].median_ticket is None and out["a"].unique_customers == 0 and out[None].p95_ticket == 5.0
    assert sketches.finished(sketches.kpi_sketches(rows.limit(0))).count() == 0
    assert sketches.customer_retention(sketches.kpi_sketches(rows.limit(0)), 6).count() == 0


# ------------------------------------------------------------ dense series

def test_a_gap_does_not_widen_the_span(spark):
    half = dt.timedelta(minutes=30)
    rows = [(T0 + half * n, "paid", "EUR", 10.0 * (n + 1)) for n in (0, 1, 5, 6)] + [(T0 + half * 3, "open", None, 7.0), (None, "paid", "EUR", 1.0)]
    kpis = spark.createDataFrame(rows, "window_start timestamp_ntz, order_status string, currency string, gross_revenue double")
    out = {(r.order_status, (r.window_start - T0) // half): r for r in calendar.dense_trend(kpis).collect()}
    assert set(out) == {("paid", n) for n in range(7)} | {("open", n) for n in range(3, 7)}
    five = out[("paid", 5)]
    assert (five.prev_value, five.value_change, five.moving_avg, five.present) == (0.0, 60.0, 15.0, True)
    assert out[("paid", 0)].prev_value is None and not out[("paid", 3)].present and out[("open", 4)].gross_revenue == 0.0
    z = {(r.order_status, (r.window_start - T0) // half): r for r in calendar.dense_anomalies(kpis, windows=2).collect()}
    assert z[("paid", 5)].trailing_n == 2 and z[("paid", 5)].z_score is None and z[("paid", 2)].trailing_mean == 15.0
    assert calendar.dense_trend(kpis.limit(0)).count() == 0


# ------------------------------------------------------------ buckets, hot keys

def test_the_timeline_of_bucketed_tables_has_no_exchange(spark, scratch):
    final, tables = _valid(spark), BucketedTables(spark, scratch("bucketed"), buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for s in SERVICES:
            tables.write(final[s].limit(3), s[:5])
            tables.write(final[s], s[:5])  # replaces the version before
        out = timeline.order_timeline(*(tables.read(s[:5]) for s in SERVICES))
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        assert as_rows(out) == as_rows(timeline.order_timeline(*(final[s] for s in SERVICES)))
        hot = final[SERVICES[0]].withColumn("order_id", F.lit("one order"))
        tables.hot, tables.hot_bytes = 2.0, 0
        tables.write(hot, "hot")
        read = tables.read("hot")  # all in one bucket: plain files
        assert "Bucketed: true" not in read._jdf.queryExecution().executedPlan().toString() and as_rows(read) == as_rows(hot)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        tables.drop()


def test_hot_keys_by_sketch(spark):
    left = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(
        F.concat(F.lit("k"), F.col("id") % 5000)).alias("key"), F.col("id").cast("string").alias("row"))
    right = left.select("key").distinct().withColumn("v", F.length("key"))
    salts = salted.sketched_salts(left, "key", 1000, tracked=1000, hottest=10).collect()
    assert [(r.key, r._salts) for r in salts] == [("hot", 10)]
    for how in ("left", "inner"):
        got = salted.salted_join(left, right, "key", "row", how, 1000, sketch=True)
        assert as_rows(got) == as_rows(left.join(right, "key", how).select(got.columns))
    assert salted.sketched_salts(left.limit(0), "key", 10).count() == 0


# ------------------------------------------------------------ streams into tables

def test_latest_table_takes_batches_in_any_order_and_again(spark, scratch):
    rnd = random.Random(5)
    rows = [(f"e{n}", f"o{rnd.randrange(40)}" if n % 30 else None, T0 + dt.timedelta(minutes=rnd.randrange(500)), f"s{n}") for n in range(400)]
    schema = "event_id string, order_id string, timestamp timestamp_ntz, status string"
    batches = [spark.createDataFrame(rows[a:a + 100], schema) for a in (200, 0, 300, 100)]
    table = LatestTable(spark, scratch("latest"), "order_id", batches[0].schema, buckets=4)
    for n, b in enumerate(batches):
        table.merge(b, n)
        if n == 2:
            table.merge(b, n)  # replayed
    table.merge(batches[0].limit(0), 9)
    best = {}
    for r in rows:
        if r[1] is not None:
            best[r[1]] = max(best.get(r[1], r), r, key=lambda x: (x[2], x[0]))
    assert {(r.event_id, r.order_id, r.timestamp, r.status) for r in table.read().collect()} == set(best.values())


def test_running_stock_of_a_stream(spark, scratch):
    rnd = random.Random(6)
    schema = ("event_id string, sku string, warehouse_id string, event_type string, quantity_delta long, quantity_after long, "
              "timestamp timestamp_ntz, service_version string")
    rows = [(f"e{n}", f"s{rnd.randrange(3)}", None if n % 11 == 0 else "w", "X", rnd.choice([None, 1, -2, 5]), None,
             T0 + dt.timedelta(minutes=n // 2), "1") for n in range(400)]
    arrival = sorted(rows, key=lambda r: (r[6] + dt.timedelta(minutes=int(r[0][1:]) * 7 % 30), r[0]))  # up to half an hour late
    parts = [spark.createDataFrame(arrival[a:b], schema) for a, b in ((0, 150), (150, 260), (260, 400))]
    stream = StockStream(spark, scratch("stock"), parts[0].schema, "30 MINUTES")
    for n, p in enumerate(parts):
        stream.take(p, n)
        stream.take(p, n)  # replayed
    stream.take(spark.createDataFrame([("late", "s0", "w", "X", 100, None, T0, "1")], schema), 3)
    stream.take(parts[0].limit(0), 4)
    whole = inventory.inventory_running(spark.createDataFrame(rows, schema))
    until = max(r[6] for r in rows) - dt.timedelta(minutes=30)
    got = stream.out()
    assert got.count() > 300 and as_rows(got) == as_rows(whole.where(F.col("timestamp") <= F.lit(until)).select(got.columns))
    assert [r.event_id for r in stream.out("late").collect()] == ["late"]
    assert got.count() + stream.waiting(4).count() == len(rows)
