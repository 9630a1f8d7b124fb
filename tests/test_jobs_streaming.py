"""The three batch jobs chained through the shared folder, and the streaming twin."""

import pytest
from pyspark.sql import functions as F

from tidewater.plans import jobs
from tidewater.plans.queries import Inputs
from tidewater.schemas import INVENTORY, ORDERS, PAYMENTS, SERVICES
from tidewater.sinks import writers
from tidewater.sources.fixtures import AS_OF
from tidewater.streaming import twin

from small_tables import SF_SMALL


@pytest.fixture(scope="module")
def landed(spark):
    from tidewater.session import scratch_path
    root = scratch_path(spark, "land")
    i = Inputs(spark, SF_SMALL)
    raw = None
    for svc in SERVICES:
        part = i.raw(svc).select(F.to_json(F.struct("*")).alias("json"), F.lit(svc).alias("service"))
        raw = part if raw is None else raw.unionByName(part)
    # land each service's events under <root>/<service>/events.jsonl, one JSON object per line
    for svc in SERVICES:
        raw.filter(F.col("service") == svc).select("json").write.mode("overwrite").text(f"{root}/{svc}/events.jsonl")
    return root


def test_three_jobs_chain(spark, landed, scratch):
    parsed, joined, metrics_out = scratch("parsed"), scratch("joined"), scratch("metrics")
    q = {r._service: r for r in jobs.parse_events(spark, landed, parsed, "run1", as_of=AS_OF).collect()}
    i = Inputs(spark, SF_SMALL)
    for svc in SERVICES:
        assert q[svc].total_records == q[svc].valid_records + q[svc].invalid_records
        assert q[svc].valid_records == i.valid(svc).count()
        # quarantine is kept next to the valid rows (not overwritten by the unified write)
        assert jobs.read_quarantine(spark, parsed, svc).count() == q[svc].invalid_records
    unified = spark.read.parquet(f"{parsed}/unified")
    assert unified.count() == sum(q[s].valid_records for s in SERVICES)
    n = jobs.cross_service_join(spark, parsed, joined, "run1")
    assert n == i.timeline().count()
    stock = spark.read.parquet(f"{joined}/inventory_running")
    assert stock.count() == i.valid(INVENTORY).count() and "warehouse_id" in stock.columns
    summary = jobs.aggregate_metrics(spark, joined, metrics_out, "run1")
    assert summary["total_records"] == n
    for t in ("order_metrics", "payment_funnel", "sla_metrics"):
        assert spark.read.parquet(f"{metrics_out}/{t}").count() > 0


def test_parse_single_service_projects_and_skips_unknown(spark, landed, scratch):
    out = scratch("one")
    q = jobs.parse_events(spark, landed, out, "r", services=f"{PAYMENTS},nope-service", as_of=AS_OF)
    assert [r._service for r in q.collect()] == [PAYMENTS]
    assert set(spark.read.parquet(f"{out}/unified").columns) == {"event_id", "event_type", "timestamp",
                                                                  "_parsed_at", "_run_id", "_service"}
    with pytest.raises(Exception):
        jobs.parse_events(spark, landed, scratch("rec"), "r", mode="recovery", services="nope-service")


def test_a_service_that_fails_leaves_no_old_rows(spark, landed, scratch):
    out = scratch("rerun")
    jobs.parse_events(spark, landed, out, "r1", as_of=AS_OF)
    assert jobs.read_valid(spark, out, PAYMENTS).count() > 0
    # the second run's payments are not there
    other = scratch("partial")
    for svc in (ORDERS, INVENTORY):
        spark.read.text(f"{landed}/{svc}/events.jsonl").write.text(f"{other}/{svc}/events.jsonl")
    q = jobs.parse_events(spark, other, out, "r2", services=f"{ORDERS},{PAYMENTS}", as_of=AS_OF)
    assert [r._service for r in q.collect()] == [ORDERS]
    assert jobs.read_valid(spark, out, PAYMENTS).count() == 0
    assert {r._service for r in spark.read.parquet(f"{out}/unified").select("_service").distinct().collect()} == {ORDERS}


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_reruns_keep_nothing_of_the_run_before(spark, scratch, mode):
    from tidewater.sinks.publish import publish_payloads
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        two = spark.createDataFrame([("a", 1), ("b", 2)], "_service string, v int")
        one = two.filter("_service = 'a'")
        path = scratch("unified")
        writers.write_unified(two, path)
        writers.write_unified(one, path)
        assert [r._service for r in spark.read.parquet(path).collect()] == ["a"]
        writers.write_partitioned(two.filter("_service = 'b'"), path, ["_service"], partial=True)  # declared partial
        assert sorted(r._service for r in spark.read.parquet(path).collect()) == ["a", "b"]

        root = scratch("quarantine")
        for svc in ("a", "b"):
            writers.write_quarantine(two.filter(F.col("_service") == svc), root, svc)
        writers.write_quarantine(two.filter("false"), root, "b")
        back = spark.read.schema("v int, _service string").parquet(root)
        assert [(r._service, r.v) for r in back.collect()] == [("a", 1)]

        stock = scratch("stock")
        writers.write_inventory(two.withColumnRenamed("_service", "warehouse_id"), stock)
        writers.write_inventory(one.withColumnRenamed("_service", "warehouse_id"), stock)
        assert spark.read.parquet(stock).count() == 1

        land = scratch("land")
        writers.land_events(two.withColumnRenamed("_service", "service"), land)
        writers.land_events(one.withColumnRenamed("_service", "service"), land)
        assert spark.read.json(land).count() == 1

        pub = scratch("pub")
        targets = {"y": None, "z": F.col("v") == 2}
        publish_payloads(spark, two, targets, "r1", pub)
        ledger = {r.target: (r.rows_written, r.status) for r in publish_payloads(spark, one, targets, "r2", pub).collect()}
        assert ledger == {"y": (1, "published"), "z": (0, "failed")}
        with pytest.raises(RuntimeError):
            publish_payloads(spark, one, targets, "r3", pub, fail_on_partial=True)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_land_parse_join_metrics_by_the_command_line(spark, scratch):
    from tidewater import cli
    land, parsed, joined, out = (scratch(x) for x in ("land", "parsed", "joined", "metrics"))
    i, raw = Inputs(spark, SF_SMALL), None
    for svc in SERVICES:
        part = i.raw(svc).withColumn("service", F.lit(svc))
        raw = part if raw is None else raw.unionByName(part, allowMissingColumns=True)
    writers.land_events(raw, land)
    run = lambda *a: cli.run(spark, cli.parser().parse_args(list(a)))
    q = run("parse", "--input", land, "--output", parsed, "--run-id", "r", "--layout", "landing", "--as-of", AS_OF)
    assert {r["_service"] for r in q["services"]} == set(SERVICES)
    assert all(r["valid_records"] == i.valid(r["_service"]).count() for r in q["services"])
    j = run("join", "--input", parsed, "--output", joined, "--run-id", "r", "--services", ",".join(SERVICES))
    assert j["orders_enriched"] == i.timeline().count()
    m = run("metrics", "--input", joined, "--output", out, "--run-id", "r", "--window", "1h")
    assert m["total_records"] == j["orders_enriched"]
    assert spark.read.text(f"{out}/run_summary").count() == 1
    few = run("join", "--input", parsed, "--output", scratch("few"), "--run-id", "r", "--services", ORDERS)
    assert few["orders_enriched"] == j["orders_enriched"]  # payments and shipments are missing, orders are not
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["metrics", "--input", "x"])


def test_stream_dedup_accounts_for_future_and_late_events(spark, scratch):
    import datetime as dt
    src, t = scratch("late"), dt.datetime(2024, 1, 15, 10, 0)
    files = [[(f"e{i}", t + dt.timedelta(minutes=i)) for i in range(50)] + [("future", dt.datetime(2034, 1, 1))],
             [(f"e{i}", t + dt.timedelta(minutes=i)) for i in range(40, 90)],
             [("late", t - dt.timedelta(days=40)), ("e3", t), (None, t), (None, t)]]
    for rows in files:
        spark.createDataFrame(rows, "event_id string, timestamp timestamp").coalesce(1).write.mode("append").json(src)
    out = scratch("late_out")
    stream = twin.stream_service_events(spark, src, ORDERS, max_files_per_trigger=1)
    twin.run_available_now(twin.stream_dedup(stream, "1 hour"), out, scratch("late_ckpt"))
    got = sorted((r.event_id or "") for r in spark.read.parquet(out).collect())
    assert got == sorted([f"e{i}" for i in range(90)] + ["future", "late", "", ""])


def test_stream_twin_matches_batch(spark, landed, scratch):
    from tidewater.functions.rules import all_pass, rules_for
    src = f"{landed}/{ORDERS}/events.jsonl"
    stream = twin.stream_service_events(spark, src, ORDERS)
    out, ckpt = scratch("stream_out"), scratch("stream_ckpt")
    twin.run_available_now(twin.stream_dedup(stream, "1 hour").drop("_corrupt_record"), out, ckpt)
    got = spark.read.parquet(out)
    batch = Inputs(spark, SF_SMALL).deduped(ORDERS)
    # every id once, keyless rows kept one by one (in-order landing: same survivors as batch)
    assert got.count() == batch.count()
    assert got.filter("event_id IS NULL").count() == batch.filter("event_id IS NULL").count() > 0
    assert got.select("event_id").distinct().count() == batch.select("event_id").distinct().count()

    kout, kckpt = scratch("kpi_out"), scratch("kpi_ckpt")
    twin.run_available_now(twin.stream_order_kpis(twin.stream_service_events(spark, src, ORDERS), as_of=AS_OF),
                           kout, kckpt)
    kpis = spark.read.parquet(kout).select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                                           "status", "currency", "event_count", F.round("revenue", 2).alias("revenue"))
    raw = Inputs(spark, SF_SMALL).raw(ORDERS)
    want = (raw.filter(all_pass(rules_for(ORDERS, AS_OF, raw.columns)))
            .groupBy(F.window("timestamp", "30 minutes").alias("w"), "status", "currency")
            .agg(F.count(F.lit(1)).alias("event_count"), F.round(F.sum("total_amount"), 2).alias("revenue"))
            .select(F.col("w.start").alias("window_start"), "status", "currency", "event_count", "revenue"))
    # every window the stream closed equals the batch aggregate of that window
    assert kpis.count() > 0
    assert kpis.exceptAll(want).count() == 0


def test_partitioned_write_splits_a_hot_partition_value(spark, scratch):
    import glob
    path = scratch("hotwrite")
    df = spark.range(40000).select(
        F.when(F.col("id") % 10 == 0, F.lit("WH-2")).otherwise(F.lit("WH-1")).alias("warehouse_id"),
        F.col("id"), (F.col("id") * 31 % 997).alias("q"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        writers.write_inventory(df, path, run_id="r")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    hot_files = glob.glob(f"{path}/warehouse_id=WH-1/*.parquet")
    # the warehouse with 90% of the rows is written by several tasks, not one
    assert len(hot_files) > 1
    assert spark.read.parquet(path).count() == 40000


def test_shared_dir_never_picks_a_local_folder_on_a_cluster():
    from types import SimpleNamespace
    from tidewater.session import shared_dir
    ctx = SimpleNamespace(master="spark://cluster:7077", getCheckpointDir=lambda: None,
                          setCheckpointDir=lambda d: None)
    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: None), sparkContext=ctx)
    with pytest.raises(RuntimeError):
        shared_dir(fake)
    named = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: "hdfs://nn/ckpt/"), sparkContext=ctx)
    assert shared_dir(named) == "hdfs://nn/ckpt"
