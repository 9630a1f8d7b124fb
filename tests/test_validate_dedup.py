"""Validation and dedup on hand-made edge rows."""

import datetime as dt

from pyspark.sql import functions as F

from tidewater.operators import dedup, validate
from tidewater.schemas import ORDERS, PAYMENTS, schema_for
from tidewater.sources.readers import normalise_timestamps

T = dt.datetime(2024, 1, 15, 10, 0, 0)
AS_OF = "2024-02-01 00:00:00"


def payments(spark, rows):
    return normalise_timestamps(spark.createDataFrame(rows, schema_for(PAYMENTS)))


def row(eid, amount=10.0, currency="BRL", ts=T, etype="PAYMENT_PROCESSED", order="o1"):
    return (eid, "p1", order, etype, amount, currency, "pix", "stripe", "approved", ts, "1")


def test_null_rule_result_is_invalid_and_counts_add_up(spark):
    df = payments(spark, [row("a"), row("b", amount=None), row("c", currency=None), row("d", amount=0.0),
                          row("e", currency="JPY"), row("f", ts=dt.datetime(2030, 1, 1)), row("g", etype=""),
                          row(None)])
    valid, invalid = validate.split_valid(df, PAYMENTS, AS_OF)
    assert [r.event_id for r in valid.collect()] == ["a"]
    assert valid.count() + invalid.count() == df.count()
    assert set(valid.columns) >= {"_service", "_parsed_at"}
    assert "_rejected_at" in invalid.columns


def test_rule_failure_names(spark):
    df = payments(spark, [row("a", amount=None, currency="JPY"), row(None, etype="")])
    flagged = validate.flag_valid(df, PAYMENTS, AS_OF, with_failures=True).withColumn("_service", F.lit(PAYMENTS))
    got = {(r.rule, r.failed_count) for r in validate.rule_failures(flagged).collect()}
    assert got == {("positive_amount", 1), ("valid_currency", 1), ("not_null_event_id", 1),
                   ("not_empty_event_type", 1)}


def test_orders_zero_amount_is_valid(spark):
    df = normalise_timestamps(spark.createDataFrame(
        [("e1", "o1", "c1", "ORDER_CREATED", "pending", 0.0, "BRL", 1, T, "1")], schema_for(ORDERS)))
    valid, _ = validate.split_valid(df, ORDERS, AS_OF)
    assert valid.count() == 1


def test_quality_metrics_empty_service_rate_zero(spark):
    df = spark.createDataFrame([], "_service string, _is_valid boolean")
    assert validate.quality_metrics(df).count() == 0
    m = spark.createDataFrame([("s", 0, 0, 0, 0.0)], "_service string, total_records long, valid_records long, "
                                                     "invalid_records long, validity_rate double")
    assert validate.quality_gate(m).first().gate_passed is False


def test_dedup_keeps_keyless_rows_singly_and_picks_earliest(spark):
    later = T + dt.timedelta(hours=1)
    df = payments(spark, [row("a", amount=2.0, ts=later), row("a", amount=1.0, ts=T), row("a", amount=3.0, ts=T),
                          row(None, amount=5.0), row(None, amount=5.0), row(None, amount=6.0)])
    out = dedup.dedup_events(df).collect()
    keyed = [r for r in out if r.event_id == "a"]
    assert len(keyed) == 1 and keyed[0].amount == 1.0
    assert sorted(r.amount for r in out if r.event_id is None) == [5.0, 5.0, 6.0]


def test_dedup_hot_key(spark):
    rows = [row("hot", amount=float(i)) for i in range(3000)] + [row(f"k{i}") for i in range(100)]
    out = dedup.dedup_events(payments(spark, rows))
    assert out.count() == 101
    assert out.filter("event_id = 'hot'").first().amount == 0.0


def test_dedup_stats(spark):
    df = spark.createDataFrame([("s", "a"), ("s", "a"), ("s", None), ("s", "b")], "_service string, event_id string")
    r = dedup.dedup_stats(df).first()
    assert (r.total_rows, r.distinct_ids, r.null_ids, r.duplicates_removed) == (4, 2, 1, 1)


def test_dedup_keyless_copies_kept_across_partitions(spark):
    # one big group of identical keyless copies, spread over several input partitions
    rows = [row(None, amount=7.0)] * 2000 + [row("a"), row("a"), row(None, amount=8.0)]
    df = payments(spark, rows).repartition(5)
    out = dedup.dedup_events(df)
    assert out.filter("event_id IS NULL AND amount = 7.0").count() == 2000
    assert out.filter("event_id IS NULL AND amount = 8.0").count() == 1
    assert out.filter("event_id = 'a'").count() == 1


def test_dedup_stats_takes_tasks_by_rows(spark, monkeypatch):
    monkeypatch.setattr(dedup, "TASK_ROWS", 20)
    df = spark.range(0, 900, 1, 6).selectExpr(
        "if(id % 3 = 0, 'hot', if(id % 7 = 1, null, concat('e', id % 400))) AS event_id", "concat('s', id % 2) AS _service")
    stats = dedup.dedup_stats(df)
    want = df.groupBy("_service").agg(F.count(F.lit(1)), F.count_distinct("event_id"), F.count_if(F.col("event_id").isNull()))
    assert {tuple(r)[:4] for r in stats.collect()} == {tuple(r) for r in want.collect()}
    assert all(r.duplicates_removed == r.total_rows - r.distinct_ids - r.null_ids for r in stats.collect())
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(event_id" in plan and plan.count(", 45), REPARTITION_BY_NUM") >= 2  # 900 rows / 20
    aggregates = [line for line in plan.split("\n") if "Aggregate" in line and "event_id" in line]
    assert aggregates and not any(line.lstrip(" +-:*()0123456789").startswith("Scan") for line in aggregates)
    assert dedup.dedup_stats(df.limit(0)).count() == 0
