"""Streams whose result is a table that changes (F1-F4): the latest event per order, and running stock.

Both run in ``foreachBatch`` on batch code, so nothing but the tables is held as state, a hot
key is split as in the batch operators, and no Python worker runs.  A micro-batch may be replayed after a
failure: what it writes depends on the tables of the batch before and on its own rows alone.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from tidewater.operators import inventory
from tidewater.operators.prefix import null_safe_join
from tidewater.operators.timeline import latest_by
from tidewater.session import delete_folders, path_exists, scratch_path

BUCKET = "_bucket"


@dataclass
class LatestTable:
    """The newest row per ``key``, by ``order`` columns, in hash buckets that are replaced one by one.

    A merge takes the greater of the stored row and the batch's, so out-of-order input and replayed batches change
    nothing.  Only the buckets with rows in the batch are read and written.
    """

    spark: SparkSession
    path: str
    key: str
    columns: StructType
    order: tuple[str, ...] = ("timestamp", "event_id")
    buckets: int = 256

    def read(self) -> DataFrame:
        return self._rows().drop(BUCKET)

    def _rows(self) -> DataFrame:
        schema = StructType([f for f in self.columns.fields if f.name != BUCKET]).add(BUCKET, IntegerType())
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path)

    def merge(self, batch: DataFrame, batch_id: int) -> None:
        """Take the rows of one micro-batch; those without a key are left out."""
        names = self.columns.fieldNames()
        keep = {c: c for c in names if c != self.key}
        bucket = F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")
        newest = latest_by(batch.select(*names).where(F.col(self.key).isNotNull()), self.key, keep, self.order).withColumn(BUCKET, bucket)
        staged = scratch_path(self.spark, f"latest-batch-{batch_id}")
        newest.write.parquet(f"{staged}/batch")
        newest = self.spark.read.schema(newest.schema).parquet(f"{staged}/batch")
        touched = [r[0] for r in newest.select(BUCKET).distinct().collect()]  # at most ``buckets``
        if touched:
            there = self._rows().where(F.col(BUCKET).isin(touched))
            both = there.select(*newest.columns).union(newest)
            merged = latest_by(both, self.key, keep | {BUCKET: BUCKET}, self.order)
            merged.write.parquet(f"{staged}/merged")
            (self.spark.read.schema(merged.schema).parquet(f"{staged}/merged").hint("rebalance", BUCKET)
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self.path))
        delete_folders(self.spark, [staged])


@dataclass
class StockStream:
    """Running stock per (sku, warehouse) out of a stream.

    Events wait until the clock (the greatest event time seen) is ``delay`` past them; then they come out
    with their totals, which rows of one time share (RANGE), however out of order they came.  An event that
    comes when its time is out already goes to ``late`` and changes no total.

    Tables under ``path``, a version for each batch: ``waiting`` (events), ``totals`` (per key) and ``clock``; ``out`` and ``late``
    have a partition for each batch.  A replayed batch starts from the version before and writes the same again.
    """

    spark: SparkSession
    path: str
    columns: StructType
    delay: str = "1 hour"

    def _versions(self, table: str, batch_id: int, schema: StructType) -> DataFrame:
        path = f"{self.path}/{table}/v={batch_id}"
        if batch_id < 0 or not path_exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def out(self, table: str = "out") -> DataFrame:
        extra = "" if table == "late" else "running_quantity bigint, stockout_risk string, "
        schema = StructType(self.columns.fields + StructType.fromDDL(f"{extra}_batch int").fields)
        if not path_exists(self.spark, f"{self.path}/{table}"):
            return self.spark.createDataFrame([], schema).drop("_batch")
        return self.spark.read.schema(schema).parquet(f"{self.path}/{table}").drop("_batch")

    def waiting(self, batch_id: int) -> DataFrame:
        return self._versions("waiting", batch_id, self.columns)

    def take(self, batch: DataFrame, batch_id: int) -> None:
        spark, names = self.spark, self.columns.fieldNames()
        clock = StructType.fromDDL("at timestamp_ntz")
        totals = StructType.fromDDL("sku string, warehouse_id string, quantity bigint, deltas bigint")
        before = self._versions("clock", batch_id - 1, clock).first()
        rows = self._store(batch.select(*names).where(F.col("timestamp").isNotNull()), "batch", batch_id)
        newest = rows.agg(F.max("timestamp").alias("at")).first()[0]
        at = max((x for x in (newest, before[0] if before else None) if x is not None), default=None)
        ripe = F.lit(at).cast("timestamp_ntz") - F.expr(f"INTERVAL {self.delay}")
        gone = F.lit(before[0] if before else None).cast("timestamp_ntz") - F.expr(f"INTERVAL {self.delay}")

        in_time = F.coalesce(F.col("timestamp") > gone, F.lit(True))
        held = self._versions("waiting", batch_id - 1, self.columns).union(rows.where(in_time))
        done = F.coalesce(F.col("timestamp") <= ripe, F.lit(False))
        earlier = self._versions("totals", batch_id - 1, totals)
        keys = list(inventory.KEYS)
        self._store(held.where(~done), "waiting", batch_id)
        self._store(rows.where(~in_time), "late", batch_id, "_batch")
        now = held.where(done)
        own = null_safe_join(now, inventory.running_totals(now), [*keys, "timestamp"], "left")
        own = null_safe_join(own, earlier, keys, "left")
        # NULL until the first delta of the key, as in the batch operator
        total = F.when(F.col("running_quantity").isNotNull() | (F.coalesce("deltas", F.lit(0)) > 0),
                       F.coalesce("running_quantity", F.lit(0)) + F.coalesce("quantity", F.lit(0)))
        own = own.withColumn("running_quantity", total).withColumn("stockout_risk", inventory.stockout_risk())
        self._store(own.select(*names, "running_quantity", "stockout_risk"), "out", batch_id, "_batch")
        sums = now.groupBy(*keys).agg(F.sum("quantity_delta").alias("quantity"), F.count("quantity_delta").alias("deltas"))
        sums = earlier.unionByName(sums).groupBy(*keys).agg(F.sum("quantity").alias("quantity"), F.sum("deltas").alias("deltas"))
        self._store(sums, "totals", batch_id)
        self._store(spark.createDataFrame([(at,)], clock), "clock", batch_id)
        # a batch can be replayed until the next one begins: the version before stays
        delete_folders(spark, [f"{self.path}/{t}/v={batch_id - 2}" for t in ("waiting", "totals", "clock")] + [f"{self.path}/batch/v={batch_id}"])

    def _store(self, df: DataFrame, table: str, batch_id: int, part: str = "v") -> DataFrame:
        path = f"{self.path}/{table}/{part}={batch_id}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def run_batches(stream: DataFrame, take: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Give everything that is there to ``take``, batch by batch, and stop; the next run goes on after it."""
    q = stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
