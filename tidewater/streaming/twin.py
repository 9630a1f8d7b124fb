"""Structured Streaming twin of the batch scan, dedup and order KPIs (M1-M3).

Not a counterpart of anything in the source jobs (they are batch-only); it
lets the same rules run incrementally over a landing folder:

* ``stream_service_events`` - the schema-checked JSON Lines scan as a stream;
* ``stream_dedup`` - ``dropDuplicatesWithinWatermark`` on ``event_id``, by time of arrival;
* ``stream_order_kpis`` - windowed order count / revenue in append mode
  (exact distinct counts and row_number are not available on streams).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.rules import all_pass, rules_for
from tidewater.functions.timefns import minutes
from tidewater.schemas import CORRUPT_COL, ORDERS, schema_for


def stream_service_events(spark: SparkSession, path: str, service: str,
                          max_files_per_trigger: int | None = None) -> DataFrame:
    reader = (spark.readStream.schema(schema_for(service, with_corrupt=True))
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT_COL))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = reader.json(path)
    # event time stays a session-zone timestamp: watermarks need TimestampType
    return df


def stream_dedup(events: DataFrame, horizon: str = "1 hour", key: str = "event_id") -> DataFrame:
    """Drop repeats of a key that arrive within ``horizon`` of its first copy;
    every other event comes out, keyless ones one by one as in the batch dedup.

    The horizon is one of arrival: the watermark follows the time at which a
    micro-batch read the event, which no event can be behind.  So an event
    with a time in the future does not make later ones late, and a late one is
    kept.  State is held per key for the horizon.
    """
    keyed = (events.filter(F.col(key).isNotNull()).withColumn("_read_at", F.current_timestamp())
             .withWatermark("_read_at", horizon).dropDuplicatesWithinWatermark([key]).drop("_read_at"))
    return keyed.unionByName(events.filter(F.col(key).isNull()))


def stream_order_kpis(orders: DataFrame, window: str = "30 minutes", watermark: str = "1 hour",
                      as_of=None) -> DataFrame:
    """Valid order events -> count and revenue per window x status x currency,
    emitted once the watermark passes the window end.

    Events after ``as_of`` are invalid and cannot move the watermark.  The
    windows of the last ``watermark`` before the newest event stay open, in the
    state, until later events close them; the batch KPIs cover them meanwhile."""
    valid = orders.filter(all_pass(rules_for(ORDERS, as_of, orders.columns)))
    return (valid.withWatermark("timestamp", watermark)
            .groupBy(F.window("timestamp", f"{minutes(window)} minutes").alias("w"), "status", "currency")
            .agg(F.count(F.lit(1)).alias("event_count"), F.sum("total_amount").alias("revenue"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "status", "currency", "event_count", "revenue"))


def run_available_now(df: DataFrame, out_path: str, checkpoint: str, mode: str = "append") -> None:
    """Process everything currently in the source, write Parquet, stop.
    ``checkpoint`` must live in the shared folder so a restarted driver resumes."""
    q = (df.writeStream.format("parquet").outputMode(mode)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start(out_path))
    q.awaitTermination()
