"""Event de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def survivor_order(columns: list[str], key: str) -> list[str]:
    """Tie-break order among copies of one key: earliest timestamp, then the
    remaining columns in schema order (NULLs first)."""
    rest = [c for c in columns if c != key]
    return (["timestamp"] if "timestamp" in rest else []) + [c for c in rest if c != "timestamp"]


def dedup_events(df: DataFrame, key: str = "event_id") -> DataFrame:
    """One row per non-NULL ``key``; rows without a key pass through one by one.

    Single pass, one shuffle: rows are grouped by ``key`` and, when the key is
    NULL, by the whole row and its input partition as well, so keyless rows
    never merge with different rows; identical keyless rows are counted and
    re-emitted as many times as they arrived.  Keying keyless copies by input
    partition bounds every re-emitted group by one input split, even when one
    group of copies holds a third of all rows; a row's input partition is
    fixed by the file splits (or the upstream hash partitioning), so a
    recomputed task rebuilds the same groups.  The survivor of a key is
    deterministic (``min`` over a struct in :func:`survivor_order`), so reruns
    after a lost executor pick the same row.  ``min`` is an ordinary
    aggregate: each map task collapses its copies of a key before the
    shuffle, so a key that holds a third of all rows costs one row per task
    on the wire.
    """
    order = survivor_order(df.columns, key)
    others = [c for c in df.columns if c != key]
    keyless = F.col(key).isNull()
    grouped = (df.groupBy(F.col(key), F.when(keyless, F.struct(*others)).alias("_row"),
                          F.when(keyless, F.spark_partition_id()).alias("_input_split"))
               .agg(F.min(F.struct(*order)).alias("_first"), F.count(F.lit(1)).alias("_copies")))
    copies = F.when(F.col(key).isNull(), F.col("_copies")).otherwise(F.lit(1).cast("long"))
    return (grouped.withColumn("_rep", F.explode(F.sequence(F.lit(1).cast("long"), copies)))
            .select(key, *[F.col(f"_first.{c}").alias(c) for c in order])
            .select(*df.columns))


def first_copies(df: DataFrame, key: str = "event_id") -> DataFrame:
    """The survivors of :func:`dedup_events` alone, without the rows that have no key; they lie by ``key``."""
    order = survivor_order(df.columns, key)
    grouped = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*order)).alias("_first"))
    return grouped.select(*[key if c == key else F.col(f"_first.{c}").alias(c) for c in df.columns])


#: Rows of a task that counts distinct keys, about; and tasks that a key's copies are spread over at first.
TASK_ROWS, SPREAD = 1_000_000, 16


def dedup_stats(df: DataFrame, service_col: str = "_service", key: str = "event_id") -> DataFrame:
    """Per service: rows, distinct keys, rows without key, duplicates removed.

    The number of tasks follows the number of rows, so a task's memory does not grow with the input, neither by the
    size of an input split nor by a fixed number of shuffle partitions.  Copies of a key meet in two steps, so
    that one with a third of all rows is not one task's.
    """
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // TASK_ROWS))
    spread = F.pmod(F.spark_partition_id(), F.lit(SPREAD))
    rows = df.select(service_col, key, spread.alias("_spread")).repartition(tasks, key, "_spread")
    copies = rows.groupBy(service_col, key, "_spread").agg(F.count(F.lit(1)).alias("_n"))
    keys = copies.repartition(tasks, key).groupBy(service_col, key).agg(F.sum("_n").alias("_n"))
    return (keys.groupBy(service_col)
            .agg(F.sum("_n").alias("total_rows"),
                 F.count(key).alias("distinct_ids"),
                 F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("_n"))), F.lit(0)).alias("null_ids"))
            .withColumn("duplicates_removed",
                        F.col("total_rows") - F.col("distinct_ids") - F.col("null_ids")))
