"""Scans, page unpacking and the operations roll-ups on hand-made inputs."""

import json

from pyspark.sql import functions as F

from tidewater.operators import ops, recovery, scope
from tidewater.schemas import CORRUPT_COL, ORDERS, PAYMENTS, SHIPPING
from tidewater.sinks.publish import payloads, publish_payloads
from tidewater.sources.export import collection_summary, unpage_export
from tidewater.sources.readers import read_service_events


def _write(path, lines):
    import os
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/part-0.json", "w") as f:
        f.write("\n".join(lines) + "\n")


def test_jsonl_scan_keeps_malformed_lines_and_parses_offsets(spark, scratch):
    path = scratch("jsonl")
    good = {"event_id": "a", "payment_id": "p", "order_id": "o", "event_type": "X", "amount": 1.5,
            "currency": "BRL", "status": "approved", "timestamp": "2024-01-15T10:00:00Z"}
    bad_type = dict(good, event_id="b", amount="lots")
    _write(path, [json.dumps(good), "{not json", json.dumps(bad_type)])
    df = read_service_events(spark, path, PAYMENTS, "json")
    rows = {r.event_id: r for r in df.collect()}
    assert str(rows["a"].timestamp) == "2024-01-15 10:00:00" and rows["a"][CORRUPT_COL] is None
    assert sum(1 for r in df.collect() if r[CORRUPT_COL] is not None) == 2
    assert dict(df.dtypes)["timestamp"] == "timestamp_ntz"


def test_empty_folder_reads_nothing(spark, scratch):
    path = scratch("empty")
    _write(path, [""])
    assert read_service_events(spark, path, ORDERS, "json").filter(F.col("event_id").isNotNull()).count() == 0


def _pages(spark, rows):
    return spark.createDataFrame(rows, "service string, page long, body string")


def _body(n, has_next, key="events", start=0):
    evs = [{"event_id": start + i, "ts": "2024-01-01T00:00:00.000001", "user_id": 1, "event_type": "view",
            "value": 1.0} for i in range(n)]
    return json.dumps({key: evs, "has_next": has_next, "total": n})


def test_unpage_stops_at_short_page_and_fails_on_corrupt(spark):
    pages = _pages(spark, [
        ("a", 1, _body(3, True)), ("a", 2, _body(2, True, start=10)), ("a", 3, _body(3, False, start=20)),
        ("b", 1, _body(3, True, key="items")), ("b", 2, _body(3, False, key="items", start=10)),
        ("c", 1, _body(3, True)), ("c", 2, '{"events": [{"event_id": 1'),
        ("d", 1, _body(3, False)), ("d", 2, "garbage after the stop page"),
    ])
    got = {(r.service, r.event_id) for r in unpage_export(pages, limit=3).collect()}
    assert {e for s, e in got if s == "a"} == {0, 1, 2, 10, 11}
    assert {e for s, e in got if s == "b"} == {0, 1, 2, 10, 11, 12}
    assert not any(s == "c" for s, _ in got)
    assert {e for s, e in got if s == "d"} == {0, 1, 2}
    summary = {r.service: r for r in collection_summary(pages, limit=3).collect()}
    assert summary["c"].services_failed == 1 and summary["c"].event_count == 0
    assert summary[None].services_collected == 3 and summary[None].event_count == 14


def test_health_truth_table(spark):
    def body(status, deps):
        return json.dumps({"status": status, "service": "s", "version": "1", "uptime": 1,
                           "dependencies": {k: {"status": v} for k, v in deps.items()}})
    rows = [
        (1, 200, body("healthy", {"db": "healthy"}), True),
        (2, 200, body("degraded", {"db": "healthy"}), False),
        (3, 503, body("healthy", {"db": "healthy"}), False),
        (4, 200, body("healthy", {}), False),
        (5, 200, body("healthy", {"db": "down"}), False),
        (6, 200, "not json", False),
    ]
    df = spark.createDataFrame([(i, c, b) for i, c, b, _ in rows], "event_id long, http_status int, body string")
    got = {r.event_id: r.ready for r in ops.health_ready(df, "healthy", ("db",)).collect()}
    assert got == {i: want for i, _, _, want in rows}


def test_health_rollup_routes(spark):
    df = spark.createDataFrame([("a", 1, "2024-01-01 00:00:00", True, "critical"),
                                ("a", 2, "2024-01-01 01:00:00", False, "critical"),
                                ("b", 3, "2024-01-01 00:00:00", True, "high")],
                               "service string, event_id long, reading_ts string, ready boolean, priority string")
    r = ops.health_rollup(df.withColumn("reading_ts", F.col("reading_ts").cast("timestamp_ntz"))).first()
    assert (r.n_services, r.n_healthy, r.critical_down, r.route) == (2, 1, True, "abort")


def test_log_triage_both_id_forms(spark):
    lines = spark.createDataFrame([
        ("x", 1, "INFO Submitted application application_1700000000_0042"),
        ("x", 2, "ERROR java.lang.RuntimeException: boom"),
        ("y", 1, "INFO registered app-20240115100000-0001"),
        ("y", 2, "container killed"),
    ] + [("y", 10 + i, f"Error {i}") for i in range(40)], "app string, line_no long, text string")
    rows = ops.log_triage(lines, tail=30).collect()
    assert {r.app_id for r in rows if r.app == "x"} == {"application_1700000000_0042"}
    ys = [r for r in rows if r.app == "y"]
    assert len(ys) == 30 and min(r.line_no for r in ys) == 20 and ys[0].app_id == "app-20240115100000-0001"


def test_stage_records_reader(spark, scratch):
    path = scratch("stages")
    _write(path, [json.dumps({"app_id": "a", "status": "COMPLETE", "numTasks": 4, "inputBytes": 10,
                              "outputBytes": 1, "shuffleReadBytes": 2}),
                  json.dumps({"app_id": "a", "status": "FAILED", "numTasks": 1})])
    r = ops.stage_metrics(ops.read_stage_records(spark, path)).first()
    assert (r.total_stages, r.completed_stages, r.failed_stages, r.total_tasks, r.input_bytes) == (2, 1, 1, 5, 10)


def test_run_status(spark):
    tasks = spark.createDataFrame([("r1", "a", "success"), ("r1", "b", "skipped"), ("r2", "a", "failed"),
                                   ("r3", "a", "upstream_failed")], "run_id string, task_id string, state string")
    got = {r.run_id: (r.pipeline_status, r.recovery_success) for r in ops.run_status(tasks).collect()}
    assert got == {"r1": ("SUCCESS", True), "r2": ("PARTIAL_FAILURE", False), "r3": ("SUCCESS", False)}


def test_priority_scope_and_recovery_slice(spark):
    ev = spark.createDataFrame([("e1", "X", "2024-01-15 23:00:00", PAYMENTS), ("e2", "X", "2024-01-15 23:00:00", SHIPPING),
                                ("e3", "X", "2024-01-15 10:00:00", PAYMENTS), ("e4", "X", "2024-01-15 23:30:00", "x")],
                               "event_id string, event_type string, timestamp string, _service string") \
        .withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    scoped = {r.event_id for r in scope.priority_scope(ev, scope.service_table(spark)).collect()}
    assert scoped == {"e1", "e3"}
    sl = recovery.recovery_slice(ev, ["all"], 2, "2024-01-16 00:00:00")
    assert {r.event_id for r in sl.collect()} == {"e1", "e2"}
    import pytest
    with pytest.raises(ValueError):
        recovery.recovery_slice(ev, ["nope"], 2, "2024-01-16 00:00:00", strict=True)


def test_recovery_validate(spark):
    o = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", None)], "event_id string, amount double")
    r = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("c", None), ("d", 1.0)], "event_id string, amount double")
    row = recovery.recovery_validate(o, r, "event_id", ("amount",)).first()
    assert (row.matched, row.changed, row.missing, row.extra, row.passed) == (2, 1, 0, 1, False)


def test_publish_payloads_ledger_and_docs(spark, scratch):
    res = spark.createDataFrame([("BRL", 1), ("USD", 2)], "currency string, n long")
    docs = [json.loads(r.payload) for r in payloads(res, {"a": None, "b": F.col("currency") == "USD"}, "r1").collect()]
    assert len(docs) == 3 and all(d["run_id"] == "r1" and d["source"] == "tidewater" for d in docs)
    ledger = {r.target: (r.rows_written, r.status) for r in publish_payloads(
        spark, res, {"a": None, "z": F.col("currency") == "JPY"}, "r1", scratch("pub")).collect()}
    assert ledger == {"a": (2, "published"), "z": (0, "failed")}
    import pytest
    with pytest.raises(RuntimeError):
        publish_payloads(spark, res, {"z": F.col("currency") == "JPY"}, "r1", scratch("pub"), fail_on_partial=True)


def test_recovery_validate_duplicated_keys_are_not_paired(spark):
    # a key with many copies on both sides: compared per key, never pair by pair
    o = spark.createDataFrame([("h", 1.0)] * 300 + [("x", 1.0), ("x", 2.0), (None, 5.0)],
                              "event_id string, amount double")
    r = spark.createDataFrame([("h", 1.0)] * 300 + [("x", 1.0), ("x", 2.0), (None, 5.0), (None, 5.0)],
                              "event_id string, amount double")
    row = recovery.recovery_validate(o, r, "event_id", ("amount",)).first()
    assert (row.original_rows, row.recovered_rows) == (303, 304)
    # h matches (same copies, same value); x has copies that disagree -> changed; NULL keys never match
    assert (row.matched, row.changed, row.missing, row.extra, row.passed) == (1, 1, 1, 2, False)
    fewer = recovery.recovery_validate(o.filter("event_id = 'h'"), r.filter("event_id = 'h'").limit(299),
                                       "event_id", ("amount",)).first()
    assert (fewer.matched, fewer.changed) == (0, 1)


def test_position_in_group_equals_row_number_on_hot_key(spark):
    from pyspark.sql import Window
    from tidewater.sources.export import position_in_group
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, F.lit("other")).otherwise(F.lit("hot")).alias("svc"),
                                  ((F.col("id") * 7919) % 100003).alias("eid"))
    got = position_in_group(df, ["svc"], "eid", width=997)
    want = df.withColumn("_pos", F.row_number().over(Window.partitionBy("svc").orderBy("eid")))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_parquet_scan_fills_missing_columns_and_keeps_types(spark, scratch):
    path = scratch("pq")
    spark.createDataFrame([("a", "o", "c", "ORDER_CREATED", 5.0, "2024-01-15 10:00:00")],
                          "event_id string, order_id string, customer_id string, event_type string, "
                          "total_amount double, timestamp string") \
        .withColumn("timestamp", F.col("timestamp").cast("timestamp")).write.parquet(path)
    df = read_service_events(spark, path, ORDERS, "parquet")
    r = df.first()
    # columns absent from the files come back as typed NULLs; the zone-aware timestamp becomes NTZ
    assert r.status is None and r.items_count is None and r[CORRUPT_COL] is None
    assert dict(df.dtypes)["timestamp"] == "timestamp_ntz" and dict(df.dtypes)["items_count"] == "bigint"
    assert str(r.timestamp) == "2024-01-15 10:00:00"


def test_order_metrics_approx_distinct_option(spark):
    import datetime as dt
    from tidewater.operators import metrics
    t = dt.datetime(2024, 1, 15, 10, 5)
    rows = [(f"o{i}", f"c{i % 40}", "paid", 10.0, "BRL", 1, t) for i in range(400)]
    enriched = spark.createDataFrame(rows, "order_id string, customer_id string, order_status string, "
                                           "total_amount double, currency string, items_count long, "
                                           "order_updated_at timestamp_ntz")
    exact = metrics.order_metrics(enriched).first()
    approx = metrics.order_metrics(enriched, exact_distinct=False).first()
    assert exact.unique_customers == 40 and abs(approx.unique_customers - 40) <= 2
    assert exact.order_count == approx.order_count == 400 and exact.window_start == dt.datetime(2024, 1, 15, 10, 0)
