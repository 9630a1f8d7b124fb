"""Result publishing (K11): one JSON document per result row and target."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def payloads(results: DataFrame, targets: dict[str, Column | None], run_id: str,
             source: str = "tidewater") -> DataFrame:
    """(target, payload JSON) rows. A row goes to every target whose condition
    holds (None = all rows). The fan-out is an ``explode`` of the matching
    target names - no join - so it scales with the results."""
    names = F.array_compact(F.array(*[
        (F.lit(t) if cond is None else F.when(cond, F.lit(t))) for t, cond in targets.items()]))
    doc = F.to_json(F.struct(F.lit(source).alias("source"), F.lit(run_id).alias("run_id"),
                             F.col("_target").alias("target"),
                             F.struct(*[F.col(c) for c in results.columns]).alias("data")))
    return results.withColumn("_target", F.explode(names)).select(F.col("_target").alias("target"),
                                                                  doc.alias("payload"))


def publish_payloads(spark: SparkSession, results: DataFrame, targets: dict[str, Column | None], run_id: str,
                     path: str, fail_on_partial: bool = False) -> DataFrame:
    """Write the payloads as JSON Lines partitioned by target and return the
    ledger (target, rows_written, status) read back from what was written.
    The write replaces what an
    earlier run left at ``path``, so the ledger counts this run alone.
    A target without rows is ``failed``; with ``fail_on_partial`` that raises."""
    payloads(results, targets, run_id).hint("rebalance", "target").write.mode("overwrite") \
        .option("partitionOverwriteMode", "static").partitionBy("target").text(path)
    # explicit schema: with no rows at all there is no target=... folder to discover
    written = (spark.read.schema("value string, target string").text(path)
               .groupBy("target").agg(F.count(F.lit(1)).alias("rows_written")))
    wanted = spark.createDataFrame([(t,) for t in targets], "target string")
    ledger = (wanted.join(written, "target", "left")
              .withColumn("rows_written", F.coalesce("rows_written", F.lit(0).cast("long")))
              .withColumn("status", F.when(F.col("rows_written") > 0, "published").otherwise("failed")))
    if fail_on_partial:
        failed = [r["target"] for r in ledger.filter(F.col("status") == "failed").select("target").collect()]
        if failed:
            raise RuntimeError(f"publishing failed for: {failed}")
    return ledger
