"""Partitioned writers.

A write replaces its whole output, so a rerun leaves no old rows; only a declared
partial rerun replaces just the partitions that it produces.  The mode is set
on each write, whatever the session says.  Instead of a fixed ``repartition(n, col)`` - which leaves one task
per distinct value and blocks AQE - writes use the REBALANCE hint: rows are
hash-placed by the partition column, and AQE splits skewed partitions and
merges small ones, so a warehouse or service holding a third of the rows is
written by many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# text formats keep all six fractional digits of a timestamp
TEXT_TS_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
                   "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def _stamp(df: DataFrame, run_id: str | None) -> DataFrame:
    return df if run_id is None else df.withColumn("_run_id", F.lit(run_id))


def write_partitioned(df: DataFrame, path: str, partition_by: list[str] | tuple[str, ...],
                      fmt: str = "parquet", run_id: str | None = None, partial: bool = False) -> None:
    """``partial``: keep the partitions of an earlier run that this one does not produce."""
    out = _stamp(df, run_id)
    if partition_by:
        out = out.hint("rebalance", *partition_by)
    w = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if partial else "static")
    if fmt in ("json", "csv"):
        w = w.options(**TEXT_TS_OPTIONS)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.format(fmt).save(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", run_id: str | None = None,
                header: bool = False) -> None:
    """Unpartitioned write; REBALANCE lets AQE pick sensible file sizes."""
    w = _stamp(df, run_id).hint("rebalance").write.mode("overwrite").format(fmt)
    if fmt in ("json", "csv"):
        w = w.options(**TEXT_TS_OPTIONS)
    if fmt == "csv":
        w = w.option("header", header)
    w.save(path)


def write_unified(unified: DataFrame, path: str, run_id: str | None = None) -> None:
    """A4: unified event log partitioned by ``_service``."""
    write_partitioned(unified, path, ["_service"], run_id=run_id)


def write_quarantine(invalid: DataFrame, root: str, service: str) -> None:
    """A5: rejected rows of one service under ``root/_service=<name>``, replacing
    that folder; no rejected rows leave an empty one.

    Each service keeps its own columns; read the root with the columns wanted.
    """
    write_table(invalid.drop("_service"), f"{root.rstrip('/')}/_service={service}")


def write_inventory(running: DataFrame, path: str, run_id: str | None = None) -> None:
    """Running stock partitioned by warehouse."""
    write_partitioned(running, path, ["warehouse_id"], run_id=run_id)


def land_events(events: DataFrame, root: str, service_col: str = "service") -> None:
    """Raw landing as JSON Lines, one folder per service
    (``root/<service_col>=<name>/part-*.json``)."""
    write_partitioned(events, root, [service_col], fmt="json")


def landing_path(root: str, service: str, service_col: str = "service") -> str:
    return f"{root.rstrip('/')}/{service_col}={service}"
