"""The three batch jobs: parse -> join -> metrics.

Each job is a function of keyword parameters (the same names as the
reference's command-line flags, plus ``as_of``) that reads, transforms and
writes; actions happen only at the writes.  Output layout under ``output``:

* ``events/<service>/_split=valid|quarantine`` - typed rows of each service
  (all service columns, lineage stamps, ``_failed_rules``); the join job reads
  ``_split=valid`` with partition pruning.
* ``unified/_service=<name>`` - the common-column event log.
* ``quality/`` - validity metrics per service.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType, TimestampNTZType, TimestampType

from tidewater.operators import dedup, inventory, metrics, timeline, unify, validate
from tidewater.schemas import CORRUPT_COL, INVENTORY, ORDERS, PAYMENTS, SERVICES, SHIPPING, schema_for
from tidewater.sinks import writers
from tidewater.sources.readers import read_service_events

log = logging.getLogger(__name__)

# where a service's events lie: one file or folder of its own, or what ``writers.land_events`` writes
DEFAULT_INPUT_LAYOUT = "{input}/{service}/events.jsonl"
LANDING_LAYOUT = "{input}/service={service}"
LAYOUTS = {"files": DEFAULT_INPUT_LAYOUT, "landing": LANDING_LAYOUT}


def _services(services) -> list[str]:
    if services in (None, "all", ["all"]):
        return list(SERVICES)
    if isinstance(services, str):
        return [s.strip() for s in services.split(",") if s.strip()]
    return list(services)


def typed_path(root: str, service: str) -> str:
    return f"{root.rstrip('/')}/events/{service}"


def typed_schema(service: str) -> StructType:
    """Columns of a service's typed table, stamps included; a table without rows has them too."""
    out = StructType()
    for f in schema_for(service, with_corrupt=True).fields:
        out.add(f.name, TimestampNTZType() if isinstance(f.dataType, TimestampType) else f.dataType)
    out.add("_failed_rules", ArrayType(StringType()))
    for c in ("_parsed_at", "_rejected_at"):
        out.add(c, TimestampNTZType())
    for c in ("_service", "_run_id", "_split"):
        out.add(c, StringType())
    return out


def _read_split(spark: SparkSession, root: str, service: str, split: str) -> DataFrame:
    return (spark.read.schema(typed_schema(service)).parquet(typed_path(root, service))
            .filter(F.col("_split") == split))


def read_valid(spark: SparkSession, root: str, service: str) -> DataFrame:
    """Valid typed rows of one service (``_split`` partition pruned)."""
    return _read_split(spark, root, service, "valid")


def read_quarantine(spark: SparkSession, root: str, service: str) -> DataFrame:
    return _read_split(spark, root, service, "quarantine")


def stamped(flagged: DataFrame, service: str, run_id: str) -> DataFrame:
    """Flagged rows with their split and lineage stamps (C11)."""
    valid, now = F.col(validate.VALID_COL), F.localtimestamp()
    return flagged.withColumns({
        "_split": F.when(valid, "valid").otherwise("quarantine"),
        "_parsed_at": F.when(valid, now), "_rejected_at": F.when(~valid, now),
        "_service": F.lit(service), "_run_id": F.lit(run_id)})


def parse_events(spark: SparkSession, input: str, output: str, run_id: str, mode: str = "normal",
                 services="all", fmt: str = "json", as_of=None,
                 input_layout: str = DEFAULT_INPUT_LAYOUT) -> DataFrame:
    """Scan -> dedup -> validate -> split -> unify, one write per service.

    The flagged rows of a service are written once, partitioned by ``_split``,
    and the quality counts are observed during that same write, so the input
    is scanned once per output instead of once per count.  Returns the
    quality metrics as a small DataFrame (also written to ``output/quality``).
    """
    metrics_rows = []
    written = []
    for service in _services(services):
        if service not in SERVICES:  # as the source: logged and left out, in any mode
            log.warning("no schema for service %r", service)
            continue
        try:
            path = input_layout.format(input=input.rstrip("/"), service=service)
            raw = read_service_events(spark, path, service, fmt)
            flagged = stamped(validate.flag_valid(dedup.dedup_events(raw), service, as_of, with_failures=True),
                              service, run_id)
            obs = Observation(f"quality_{service.replace('-', '_')}")
            flagged = flagged.observe(
                obs, F.count(F.lit(1)).alias("total_records"),
                F.count_if(F.col(validate.VALID_COL)).alias("valid_records"))
            writers.write_partitioned(flagged.drop(validate.VALID_COL), typed_path(output, service), ["_split"])
            m = obs.get
            total, valid = int(m["total_records"]), int(m["valid_records"])
            metrics_rows.append((service, total, valid, total - valid, valid / total if total else 0.0))
            written.append(service)
            log.info("%s: %d rows, %d valid", service, total, valid)
        except Exception:
            log.exception("parse failed for %s", service)
            # no rows of an earlier run may pass for this one's
            writers.write_partitioned(spark.createDataFrame([], typed_schema(service)), typed_path(output, service), ["_split"])
            if mode == "recovery":
                raise
    if not written or all(r[2] == 0 for r in metrics_rows):
        raise RuntimeError("no valid events were produced")
    frames = {s: read_valid(spark, output, s) for s in written}
    writers.write_unified(unify.unify_services(frames, extra=("_parsed_at",)), f"{output.rstrip('/')}/unified",
                          run_id=run_id)
    quality = spark.createDataFrame(
        metrics_rows, "_service string, total_records long, valid_records long, invalid_records long, "
                      "validity_rate double")
    writers.write_table(quality.coalesce(1), f"{output.rstrip('/')}/quality", run_id=run_id)
    return quality


def cross_service_join(spark: SparkSession, input: str, output: str, run_id: str, services="all") -> int:
    """Order timeline and running stock from the parse job's typed tables.
    ``services``: those that were parsed; the others count as empty.
    Returns the number of enriched orders (observed during the write)."""
    there = _services(services)

    def valid(service: str) -> DataFrame:
        if service in there:
            return read_valid(spark, input, service)
        return spark.createDataFrame([], typed_schema(service))

    enriched = timeline.order_timeline(valid(ORDERS), valid(PAYMENTS), valid(SHIPPING), stamp=True)
    obs = Observation("enriched_rows")
    enriched = enriched.observe(obs, F.count(F.lit(1)).alias("rows"))
    writers.write_table(enriched, f"{output.rstrip('/')}/orders_enriched", run_id=run_id)
    running = inventory.inventory_running(
        valid(INVENTORY).drop("_split", "_parsed_at", "_rejected_at", "_service", "_run_id", "_failed_rules", CORRUPT_COL))
    writers.write_inventory(running, f"{output.rstrip('/')}/inventory_running", run_id=run_id)
    return int(obs.get["rows"])


def aggregate_metrics(spark: SparkSession, input: str, output: str, run_id: str,
                      window: str = "30 minutes", mode: str = "normal", accuracy: int = 10000) -> dict:
    """Order KPIs, payment funnel, SLA table and the run summary (JSON).  The
    rows read are counted by the write of the cells, which reads the table once
    for the funnel and the SLA table; both are finished from the stored cells."""
    root = output.rstrip("/")
    enriched = spark.read.parquet(f"{input.rstrip('/')}/orders_enriched")
    obs = Observation("enriched_read")
    counted = enriched.observe(obs, F.count(F.lit(1)).alias("rows"))
    writers.write_table(metrics.kpi_cells(counted), f"{root}/kpi_cells", run_id=run_id)
    cells = spark.read.parquet(f"{root}/kpi_cells")
    tables = {
        "order_metrics": metrics.order_metrics(enriched, window, accuracy),
        "payment_funnel": metrics.payment_funnel(cells),
        "sla_metrics": metrics.sla_metrics(cells),
    }
    for name, df in tables.items():
        writers.write_table(df, f"{root}/{name}", run_id=run_id)
    total = int(obs.get["rows"])
    summary = spark.range(1).select(metrics.summary_json(run_id, F.lit(total).cast("long"), tuple(tables)))
    summary.coalesce(1).write.mode("overwrite").text(f"{root}/run_summary")
    return {"run_id": run_id, "total_records": total, "metrics_computed": list(tables)}
