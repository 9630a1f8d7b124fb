"""The unified event log laid out by service and hour (K9).

A recovery run asks for a few hours of a few services.  The log lies in
``_service=<name>/_hour=<yyyy-MM-ddTHH>/``, so that both prune: what a slice reads
grows with its window alone, not with the history.  ``recovery_slice`` prunes by hour
wherever the column is there.  Events without a timestamp lie in an hour of their own (NULL), which no slice reads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidewater.sinks.writers import write_partitioned

HOUR = "_hour"
LOG_PARTITIONS = ("_service", HOUR)


def hour_of(ts: Column) -> Column:
    """The hour of a wall clock time, as text that sorts like the time."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH")


def write_event_log(events: DataFrame, path: str, run_id: str | None = None, partial: bool = False) -> None:
    """``partial``: a rerun of some hours replaces only those (and must hold all their events)."""
    write_partitioned(events.withColumn(HOUR, hour_of(F.col("timestamp"))), path, LOG_PARTITIONS, run_id=run_id, partial=partial)


def read_event_log(spark: SparkSession, path: str, columns: StructType) -> DataFrame:
    """``columns``: those of the events, without ``_service`` and the hour."""
    own = [f for f in columns.fields if f.name not in LOG_PARTITIONS]
    schema = StructType([*own, *(StructField(c, StringType()) for c in LOG_PARTITIONS)])
    return spark.read.schema(schema).parquet(path)
