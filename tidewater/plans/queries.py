"""Query registry: one Spark callable and (where SQL can say it) one DuckDB
oracle per operator of the inventory.  Every query reads the test tables of
``sf_dir`` (or data Spark derives from them) in full."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators import dedup, timeline, validate
from tidewater.plans.oracle import SHORT, with_ctes
from tidewater.schemas import INVENTORY, ORDERS, PAYMENTS, SERVICES, SHIPPING
from tidewater.sources.fixtures import AS_OF, Fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def money(c):
    return F.round(c, 2)


def rate(c):
    return F.round(c, 6)


# ---------------------------------------------------------------- shared inputs

class Inputs:
    """Fixture streams of one sf folder, de-duplicated and validated lazily."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.fx = Fixtures(spark, sf_dir)
        self.spark = spark

    def raw(self, service: str) -> DataFrame:
        return self.fx.service(service)

    def deduped(self, service: str) -> DataFrame:
        return dedup.dedup_events(self.raw(service))

    def flagged(self, service: str, with_failures: bool = False) -> DataFrame:
        return (validate.flag_valid(self.deduped(service), service, AS_OF, with_failures)
                .withColumn("_service", F.lit(service)))

    def valid(self, service: str) -> DataFrame:
        valid, _ = validate.split_valid(self.deduped(service), service, AS_OF, stamp_col=False)
        return valid.drop("_service")

    def invalid(self, service: str) -> DataFrame:
        _, invalid = validate.split_valid(self.deduped(service), service, AS_OF, stamp_col=False)
        return invalid

    def timeline(self) -> DataFrame:
        return timeline.order_timeline(self.valid(ORDERS), self.valid(PAYMENTS), self.valid(SHIPPING))

    def unified(self) -> DataFrame:
        from tidewater.operators.unify import unify_services
        return unify_services({s: self.valid(s) for s in SERVICES})


def _in(spark, sf_dir) -> Inputs:
    return Inputs(spark, sf_dir)


# ---------------------------------------------------------------- B, D: validation and dedup

@register("dedup_events", with_ctes("SELECT * FROM dd_inventory", "dd_inventory"))
def q_dedup_events(spark, sf_dir):
    return _in(spark, sf_dir).deduped(INVENTORY)


_STATS_SQL = " UNION ALL ".join(
    f"SELECT '{svc}' AS _service, count(*) AS total_rows, count(DISTINCT event_id) AS distinct_ids, "
    f"count(*) FILTER (WHERE event_id IS NULL) AS null_ids, "
    f"count(*) - count(DISTINCT event_id) - count(*) FILTER (WHERE event_id IS NULL) AS duplicates_removed "
    f"FROM fx_{s}" for svc, s in SHORT.items())


@register("dedup_stats", with_ctes(_STATS_SQL, *[f"fx_{s}" for s in SHORT.values()]))
def q_dedup_stats(spark, sf_dir):
    i = _in(spark, sf_dir)
    raw = None
    for svc in SERVICES:
        part = i.raw(svc).select("event_id", F.lit(svc).alias("_service"))
        raw = part if raw is None else raw.unionByName(part)
    return dedup.dedup_stats(raw)


@register("valid_events_common", with_ctes(
    "SELECT * FROM fx_orders WHERE coalesce(event_id IS NOT NULL AND \"timestamp\" IS NOT NULL AND "
    "\"timestamp\" <= TIMESTAMP '2024-02-01 00:00:00' AND event_type IS NOT NULL AND event_type <> '', false)",
    "fx_orders"))
def q_valid_events_common(spark, sf_dir):
    # the four common rules only (no service-specific rule), before dedup
    raw = _in(spark, sf_dir).raw(ORDERS)
    return validate.flag_valid(raw, "any-service", AS_OF).filter("_is_valid").drop("_is_valid")


@register("valid_payments", with_ctes("SELECT * FROM valid_payments", "valid_payments"))
def q_valid_payments(spark, sf_dir):
    return _in(spark, sf_dir).valid(PAYMENTS)


@register("valid_orders", with_ctes("SELECT * FROM valid_orders", "valid_orders"))
def q_valid_orders(spark, sf_dir):
    return _in(spark, sf_dir).valid(ORDERS)


@register("validation_flag", with_ctes("SELECT * FROM flag_orders", "flag_orders"))
def q_validation_flag(spark, sf_dir):
    return validate.flag_valid(_in(spark, sf_dir).deduped(ORDERS), ORDERS, AS_OF)


@register("valid_split", with_ctes(
    "SELECT *, 'valid' AS _split FROM valid_payments UNION ALL "
    "SELECT *, 'quarantine' AS _split FROM invalid_payments", "valid_payments", "invalid_payments"))
def q_valid_split(spark, sf_dir):
    # one pass: both sides are the flagged rows, told apart by a column
    flagged = validate.flag_valid(_in(spark, sf_dir).deduped(PAYMENTS), PAYMENTS, AS_OF)
    split = F.when(F.col(validate.VALID_COL), "valid").otherwise("quarantine")
    return flagged.withColumn("_split", split).drop(validate.VALID_COL)


def _quality(i: Inputs) -> DataFrame:
    flagged = None
    for svc in SERVICES:
        part = i.flagged(svc).select("_service", validate.VALID_COL)
        flagged = part if flagged is None else flagged.unionByName(part)
    return validate.quality_metrics(flagged)


_QUALITY_SQL = " UNION ALL ".join(
    f"SELECT '{svc}' AS _service, count(*) AS total_records, count(*) FILTER (WHERE _is_valid) AS valid_records, "
    f"count(*) FILTER (WHERE NOT _is_valid) AS invalid_records FROM flag_{s}" for svc, s in SHORT.items())


@register("quality_metrics", with_ctes(
    f"SELECT *, round(coalesce(valid_records / nullif(total_records, 0), 0.0), 6) AS validity_rate FROM ({_QUALITY_SQL})",
    *[f"flag_{s}" for s in SHORT.values()]))
def q_quality_metrics(spark, sf_dir):
    return _quality(_in(spark, sf_dir)).withColumn("validity_rate", rate(F.col("validity_rate")))


@register("quality_overall", with_ctes(
    f"SELECT CAST(sum(valid_records) AS BIGINT) AS total_valid, CAST(sum(invalid_records) AS BIGINT) AS total_invalid, "
    f"round(coalesce(sum(valid_records) / nullif(sum(valid_records) + sum(invalid_records), 0), 0.0), 6) "
    f"AS overall_validity_rate FROM ({_QUALITY_SQL})", *[f"flag_{s}" for s in SHORT.values()]))
def q_quality_overall(spark, sf_dir):
    return (validate.quality_overall(_quality(_in(spark, sf_dir)))
            .withColumn("overall_validity_rate", rate(F.col("overall_validity_rate"))))


@register("quality_gate", with_ctes(
    f"SELECT _service, round(r, 6) AS validity_rate, r >= 0.95 AS gate_passed FROM "
    f"(SELECT _service, coalesce(valid_records / nullif(total_records, 0), 0.0) AS r FROM ({_QUALITY_SQL}))",
    *[f"flag_{s}" for s in SHORT.values()]))
def q_quality_gate(spark, sf_dir):
    gate = validate.quality_gate(_quality(_in(spark, sf_dir)), 0.95)
    return gate.select("_service", rate(F.col("validity_rate")).alias("validity_rate"), "gate_passed")


def _rule_failures_sql() -> str:
    from tidewater.plans.oracle import rules_sql
    parts = []
    for svc, s in SHORT.items():
        for name, expr in rules_sql(svc):
            parts.append(f"SELECT '{svc}' AS _service, '{name}' AS rule, count(*) AS failed_count "
                         f"FROM dd_{s} WHERE NOT coalesce({expr}, false)")
    return "SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE failed_count > 0"


@register("rule_failures", with_ctes(_rule_failures_sql(), *[f"dd_{s}" for s in SHORT.values()]))
def q_rule_failures(spark, sf_dir):
    i = _in(spark, sf_dir)
    flagged = None
    for svc in SERVICES:
        part = i.flagged(svc, with_failures=True).select("_service", validate.FAILED_COL)
        flagged = part if flagged is None else flagged.unionByName(part)
    return validate.rule_failures(flagged)


# ---------------------------------------------------------------- C, E, F: latest + timeline

@register("orders_latest", with_ctes("SELECT * FROM latest_orders", "latest_orders"))
def q_orders_latest(spark, sf_dir):
    return timeline.orders_latest(_in(spark, sf_dir).valid(ORDERS))


@register("payments_latest", with_ctes("SELECT * FROM latest_payments", "latest_payments"))
def q_payments_latest(spark, sf_dir):
    return timeline.payments_latest(_in(spark, sf_dir).valid(PAYMENTS))


@register("shipping_latest", with_ctes("SELECT * FROM latest_shipping", "latest_shipping"))
def q_shipping_latest(spark, sf_dir):
    return timeline.shipping_latest(_in(spark, sf_dir).valid(SHIPPING))


@register("orders_with_payments", with_ctes(
    "SELECT * FROM latest_orders LEFT JOIN latest_payments USING (order_id)", "latest_orders", "latest_payments"))
def q_orders_with_payments(spark, sf_dir):
    i = _in(spark, sf_dir)
    return timeline.orders_with_payments(timeline.orders_latest(i.valid(ORDERS)),
                                         timeline.payments_latest(i.valid(PAYMENTS)))


@register("orders_with_shipping", with_ctes(
    "SELECT * FROM latest_orders LEFT JOIN latest_shipping USING (order_id)", "latest_orders", "latest_shipping"))
def q_orders_with_shipping(spark, sf_dir):
    i = _in(spark, sf_dir)
    return timeline.orders_with_shipping(timeline.orders_latest(i.valid(ORDERS)),
                                         timeline.shipping_latest(i.valid(SHIPPING)))


@register("order_timeline", with_ctes("SELECT * FROM timeline", "timeline"))
def q_order_timeline(spark, sf_dir):
    return _in(spark, sf_dir).timeline()


@register("payment_match", with_ctes(
    "SELECT order_id, total_amount, payment_amount, payment_match FROM timeline", "timeline"))
def q_payment_match(spark, sf_dir):
    return _in(spark, sf_dir).timeline().select("order_id", "total_amount", "payment_amount", "payment_match")


@register("order_lifecycle", with_ctes(
    "SELECT order_id, order_updated_at, shipping_updated_at, order_lifecycle_hours FROM timeline", "timeline"))
def q_order_lifecycle(spark, sf_dir):
    return (_in(spark, sf_dir).timeline()
            .select("order_id", "order_updated_at", "shipping_updated_at", "order_lifecycle_hours"))


# ---------------------------------------------------------------- H: unified log

@register("unified_events", with_ctes("SELECT * FROM unified", "unified"))
def q_unified_events(spark, sf_dir):
    return _in(spark, sf_dir).unified()


@register("service_event_counts", with_ctes(
    "SELECT _service, count(*) AS event_count FROM unified GROUP BY _service", "unified"))
def q_service_event_counts(spark, sf_dir):
    return _in(spark, sf_dir).unified().groupBy("_service").agg(F.count(F.lit(1)).alias("event_count"))
