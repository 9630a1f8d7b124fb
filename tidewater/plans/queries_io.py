"""Registry entries for sources and sinks: each writes Spark-derived data to
the shared folder (``spark.checkpoint.dir``), reads it back through the
operator under test, and returns what it read."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators import inventory, validate
from tidewater.plans import jobs
from tidewater.plans.oracle import SHORT, with_ctes
from tidewater.plans.queries import _in, register
from tidewater.schemas import COMMON_COLUMNS, CORRUPT_COL, INVENTORY, ORDERS, PAYMENTS, SERVICES
from tidewater.session import scratch_path
from tidewater.sinks import writers
from tidewater.sources.fixtures import AS_OF
from tidewater.sources.readers import read_service_events, read_service_partition

RUN_ID = "manual__2024-02-01T00:00:00"


@register("scan_service_jsonl", with_ctes("SELECT * FROM fx_orders", "fx_orders"))
def q_scan_service_jsonl(spark, sf_dir):
    """A1: land the raw order events as JSON Lines, read them back with the
    fixed schema (malformed lines would surface in ``_corrupt_record``)."""
    root = scratch_path(spark, "landing")
    raw = _in(spark, sf_dir).raw(ORDERS).withColumn("service", F.lit(ORDERS))
    writers.land_events(raw, root)
    back = read_service_events(spark, writers.landing_path(root, ORDERS), ORDERS, "json")
    return back.drop(CORRUPT_COL)


@register("scan_service_csv", with_ctes("SELECT * FROM fx_payments", "fx_payments"))
def q_scan_service_csv(spark, sf_dir):
    """L1: the same scan over CSV with a header row."""
    path = scratch_path(spark, "csv")
    writers.write_table(_in(spark, sf_dir).raw(PAYMENTS), path, fmt="csv", header=True)
    return read_service_events(spark, path, PAYMENTS, "csv").drop(CORRUPT_COL)


def _write_unified(spark, sf_dir):
    path = scratch_path(spark, "unified")
    writers.write_unified(_in(spark, sf_dir).unified(), path, run_id=RUN_ID)
    return path


@register("scan_service_partition", with_ctes(
    "SELECT * FROM unified WHERE _service = 'payments-service'", "unified"))
def q_scan_service_partition(spark, sf_dir):
    """A2: one service out of the partitioned log (partition pruned)."""
    path = _write_unified(spark, sf_dir)
    return read_service_partition(spark, path, PAYMENTS).select(*COMMON_COLUMNS, "_service")


@register("sink_unified_counts", with_ctes(
    f"SELECT _service, '{RUN_ID}' AS _run_id, count(*) AS event_count FROM unified GROUP BY _service", "unified"))
def q_sink_unified_counts(spark, sf_dir):
    """A4: write the unified log, read it back, count per partition."""
    path = _write_unified(spark, sf_dir)
    return spark.read.parquet(path).groupBy("_service", "_run_id").agg(F.count(F.lit(1)).alias("event_count"))


@register("quarantine_rows", with_ctes(" UNION ALL ".join(
    f"SELECT '{svc}' AS _service, event_id, event_type, \"timestamp\" FROM invalid_{s}"
    for svc, s in (("orders-service", "orders"), ("payments-service", "payments"),
                   ("inventory-service", "inventory"), ("shipping-service", "shipping"))),
    "invalid_orders", "invalid_payments", "invalid_inventory", "invalid_shipping"))
def q_quarantine_rows(spark, sf_dir):
    """Each service's rejected rows into one quarantine root, read back
    for the common columns (schemas differ per service)."""
    i = _in(spark, sf_dir)
    root = scratch_path(spark, "quarantine")
    for svc in SERVICES:
        writers.write_quarantine(i.invalid(svc), root, svc)
    back = spark.read.schema("event_id string, event_type string, timestamp timestamp_ntz, _service string").parquet(root)
    return back.select("_service", *COMMON_COLUMNS)


# ---------------------------------------------------------------- A3, A6, A7, A8, C11

@register("sink_enriched", with_ctes(f"SELECT *, '{RUN_ID}' AS _run_id FROM timeline", "timeline"))
def q_sink_enriched(spark, sf_dir):
    """A6 + A3: write the enriched timeline and scan it back."""
    path = scratch_path(spark, "enriched")
    writers.write_table(_in(spark, sf_dir).timeline(), path, run_id=RUN_ID)
    return spark.read.parquet(path)


@register("sink_stock", with_ctes(f"""
SELECT *, CAST(sum(quantity_delta) OVER (PARTITION BY sku, warehouse_id ORDER BY "timestamp") AS BIGINT) AS running_quantity,
       '{RUN_ID}' AS _run_id FROM valid_inventory""", "valid_inventory"))
def q_sink_stock(spark, sf_dir):
    """Write the running stock by warehouse and scan it back."""
    path = scratch_path(spark, "stock")
    writers.write_inventory(inventory.inventory_running(_in(spark, sf_dir).valid(INVENTORY)), path, run_id=RUN_ID)
    return spark.read.parquet(path).drop("stockout_risk")


_METRIC_COUNTS = {"order_metrics": "order_count", "payment_funnel": "transaction_count", "sla_metrics": "order_count"}


@register("sink_metric_tables", with_ctes(f"""
SELECT 'order_metrics' AS metric_table, '{RUN_ID}' AS _run_id, count(*) AS n_rows, CAST(sum(n) AS BIGINT) AS n_orders
FROM (SELECT count(order_id) AS n FROM timeline WHERE order_updated_at IS NOT NULL
      GROUP BY time_bucket(INTERVAL '30 minutes', order_updated_at, TIMESTAMP '1970-01-01'), order_status, currency)
UNION ALL SELECT 'payment_funnel', '{RUN_ID}', count(*), CAST(sum(n) AS BIGINT)
FROM (SELECT count(order_id) AS n FROM timeline WHERE payment_status IS NOT NULL
      GROUP BY payment_method, payment_gateway, payment_status)
UNION ALL SELECT 'sla_metrics', '{RUN_ID}', count(*), CAST(sum(n) AS BIGINT)
FROM (SELECT count(order_id) AS n FROM timeline WHERE order_lifecycle_hours IS NOT NULL
      GROUP BY order_lifecycle_hours <= 24.0, currency)""", "timeline"))
def q_sink_metric_tables(spark, sf_dir):
    """The metrics job over a written timeline; its tables read back."""
    joined, out = scratch_path(spark, "joined"), scratch_path(spark, "metrics")
    writers.write_table(_in(spark, sf_dir).timeline(), f"{joined}/orders_enriched")
    jobs.aggregate_metrics(spark, joined, out, RUN_ID)
    parts = [spark.read.parquet(f"{out}/{t}").groupBy(F.lit(t).alias("metric_table"), "_run_id")
             .agg(F.count(F.lit(1)).alias("n_rows"), F.sum(n).alias("n_orders")) for t, n in _METRIC_COUNTS.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("lineage_stamps", with_ctes(" UNION ALL ".join(
    f"SELECT event_id, CASE WHEN _is_valid THEN 'valid' ELSE 'quarantine' END AS _split, '{svc}' AS _service, "
    f"'{RUN_ID}' AS _run_id, _is_valid AS parsed, NOT _is_valid AS rejected FROM flag_{s}"
    for svc, s in SHORT.items()), *[f"flag_{s}" for s in SHORT.values()]))
def q_lineage_stamps(spark, sf_dir):
    """C11 without the clock: split, service and run of each row, and which time stamp it has."""
    i, out = _in(spark, sf_dir), None
    for svc in SERVICES:
        rows = jobs.stamped(validate.flag_valid(i.deduped(svc), svc, AS_OF), svc, RUN_ID).select(
            "event_id", "_split", "_service", "_run_id", F.col("_parsed_at").isNotNull().alias("parsed"),
            F.col("_rejected_at").isNotNull().alias("rejected"))
        out = rows if out is None else out.unionByName(rows)
    return out
