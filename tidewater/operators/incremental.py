"""Incremental maintenance of the KPIs after late, changed and deleted events (K9 with G1, G2, G4).

The state of a run lies in tables whose partitions can be replaced one by one:

* ``events/<service>/_bucket=<b>``: valid typed events, by hash of ``order_id``;
* ``timeline/_part=<time>``: the enriched orders, by the part of the day (one or more KPI windows) of ``order_updated_at``;
* ``order_metrics/_part=<time>`` and ``kpi_cells/_part=<time>``: what each part adds to the KPIs;
* ``order_parts/_bucket=<b>``: the part that each order is in.

A delta names the orders that it touches.  Their buckets are merged, their timeline rows are computed anew,
and the parts that they were in or are in now are replaced; all else stays as
it is.  Order metrics are read as stored; funnel, approval rates and SLA are finished from the cells.
The steps can be repeated: ``order_parts``, which says what must be replaced, is
written last, so a delta that fails in between is applied again from its start.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType, TimestampNTZType, TimestampType

from tidewater.functions.timefns import minutes
from tidewater.operators import metrics, timeline
from tidewater.schemas import ORDERS, PAYMENTS, SHIPPING, schema_for
from tidewater.session import delete_folders, path_exists, scratch_path

SERVICES = (ORDERS, PAYMENTS, SHIPPING)
BUCKET, PART = "_bucket", "_part"
#: Buckets of the events; a state keeps the number it was begun with.
BUCKETS = 1 << 10
#: Orders that a delta touches are broadcast up to this number (ids of some 40 bytes), else they are shuffled.
BROADCAST_ORDERS = 100_000


def typed(service: str) -> StructType:
    """Columns of a service's events after the scan: times are wall clock times."""
    out = StructType()
    for f in schema_for(service).fields:
        out.add(f.name, TimestampNTZType() if f.dataType == TimestampType() else f.dataType)
    return out


class KpiState:
    def __init__(self, spark: SparkSession, root: str, window: str = "30 minutes", part: str = "1 hour", buckets: int = BUCKETS,
                 accuracy: int = 10000):
        if minutes(part) % minutes(window):
            raise ValueError("a part must hold whole windows")
        self.spark, self.root, self.window, self.buckets, self.accuracy = spark, root.rstrip("/"), window, buckets, accuracy
        self.part = part
        self._schemas: dict[str, StructType] = {}

    # ------------------------------------------------------------ tables

    def _path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _bucketed(self, df: DataFrame) -> DataFrame:
        return df.withColumn(BUCKET, F.pmod(F.xxhash64("order_id"), F.lit(self.buckets)).cast("int"))

    def _parted(self, df: DataFrame, ts: str) -> DataFrame:
        start = F.window(ts, f"{minutes(self.part)} minutes")["start"]
        return df.withColumn(PART, F.date_format(start, "yyyy-MM-dd'T'HH-mm-ss"))

    def events(self, service: str) -> DataFrame:
        schema = typed(service).add(BUCKET, IntegerType())
        if not path_exists(self.spark, self._path(f"events/{service}")):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self._path(f"events/{service}"))

    def _table(self, name: str) -> DataFrame:
        if name not in self._schemas:  # those of the operators, from no rows
            none = timeline.order_timeline(*(self.spark.createDataFrame([], typed(s)) for s in SERVICES))
            rows = self._parted(none, "order_updated_at")
            shapes = {"timeline": rows} | self._kpis(rows)
            self._schemas = {t: StructType([f for f in df.schema.fields if f.name != PART]).add(PART, StringType())
                             for t, df in shapes.items()}
        schema = self._schemas[name]
        if not path_exists(self.spark, self._path(name)):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self._path(name))

    def timeline(self) -> DataFrame:
        return self._table("timeline")

    def order_metrics(self) -> DataFrame:
        return self._table("order_metrics").drop(PART)

    def cells(self) -> DataFrame:
        return self._table("kpi_cells")

    def _order_parts(self) -> DataFrame:
        path = self._path("order_parts")
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], f"order_id string, {PART} string, {BUCKET} int")
        return self.spark.read.schema(f"order_id string, {PART} string, {BUCKET} int").parquet(path)

    # ------------------------------------------------------------ writes

    def _replace(self, df: DataFrame, table: str, column: str, values: list) -> None:
        """The partitions ``values`` of a table become the rows of ``df``; those without rows go.

        ``df`` is written elsewhere first, as it reads the table.
        """
        staged = scratch_path(self.spark, "kpi-state")
        df.write.parquet(staged)
        there = self.spark.read.schema(df.schema).parquet(staged)
        (there.hint("rebalance", column).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(column).parquet(self._path(table)))
        kept = {r[0] for r in there.select(column).distinct().collect()}  # partitions of the delta
        delete_folders(self.spark, [f"{self._path(table)}/{column}={v}" for v in values if v not in kept])
        delete_folders(self.spark, [staged])

    def build(self, events: dict[str, DataFrame]) -> None:
        """The whole state from valid typed events of each service."""
        for s in SERVICES:
            self._whole(self._bucketed(events[s].select(*schema_for(s).fieldNames())), f"events/{s}", BUCKET)
        self._whole(self._parted(timeline.order_timeline(*(self.events(s).drop(BUCKET) for s in SERVICES)),
                                   "order_updated_at"), "timeline", PART)
        for table, df in self._kpis(self.timeline()).items():
            self._whole(df, table, PART)
        self._whole(self._bucketed(self.timeline().select("order_id", PART)), "order_parts", BUCKET)

    def _whole(self, df: DataFrame, table: str, column: str) -> None:
        df.hint("rebalance", column).write.mode("overwrite").partitionBy(column).parquet(self._path(table))

    def _kpis(self, rows: DataFrame) -> dict[str, DataFrame]:
        kpis = metrics.order_metrics(rows, self.window, self.accuracy)
        return {"order_metrics": self._parted(kpis, "window_start"), "kpi_cells": metrics.kpi_cells(rows, PART)}

    # ------------------------------------------------------------ deltas

    def apply(self, upserts: dict[str, DataFrame], deletes: dict[str, DataFrame]) -> dict[str, int]:
        """Take late and changed events (``upserts``: valid typed rows; an event_id that is there is replaced) and
        ``deletes`` (event_id, order_id) into the state.

        An event that moves to another order is a delete under the old order and an upsert under the new.  Returns
        how many orders, buckets and parts were touched.
        """
        spark = self.spark
        empty = {s: spark.createDataFrame([], typed(s)) for s in SERVICES}
        new = {s: self._bucketed(upserts.get(s, empty[s]).select(*schema_for(s).fieldNames())) for s in SERVICES}
        gone = {s: self._bucketed(deletes.get(s, empty[s]).select("event_id", "order_id")) for s in SERVICES}
        touched = None
        for s in SERVICES:
            for df in (new[s], gone[s]):
                part = df.select("order_id", BUCKET)
                touched = part if touched is None else touched.union(part)
        path = scratch_path(spark, "touched-orders")
        touched.distinct().write.parquet(path)
        orders = spark.read.schema(touched.schema).parquet(path)
        n_orders = orders.count()
        if not n_orders:
            return {"orders": 0, "buckets": 0, "parts": 0}
        buckets = sorted(r[0] for r in orders.select(BUCKET).distinct().collect())  # at most ``self.buckets``
        few = F.broadcast(orders) if n_orders <= BROADCAST_ORDERS else orders

        was = (self._order_parts().where(F.col(BUCKET).isin(buckets)).join(few.select("order_id"), "order_id", "left_semi")
               .select(PART))
        for s in SERVICES:
            replaced = new[s].select(BUCKET, "event_id").union(gone[s].select(BUCKET, "event_id"))
            kept = self.events(s).where(F.col(BUCKET).isin(buckets)).join(replaced, [BUCKET, "event_id"], "left_anti")
            self._replace(kept.select(*new[s].columns).union(new[s]), f"events/{s}", BUCKET, buckets)
        own = {s: self.events(s).where(F.col(BUCKET).isin(buckets)).join(few.select("order_id"), "order_id", "left_semi")
               .drop(BUCKET) for s in SERVICES}
        path = scratch_path(spark, "touched-timeline")
        fresh = self._parted(timeline.order_timeline(*(own[s] for s in SERVICES)), "order_updated_at")
        fresh.write.parquet(path)
        fresh = spark.read.schema(fresh.schema).parquet(path)
        # the parts of a delta: as many as the history has at most, text of 19 characters each
        parts = sorted(r[0] for r in was.union(fresh.select(PART)).distinct().collect())

        stays = self.timeline().where(F.col(PART).isin(parts)).join(few.select("order_id"), "order_id", "left_anti")
        self._replace(stays.select(*fresh.columns).union(fresh), "timeline", PART, parts)
        for table, df in self._kpis(self.timeline().where(F.col(PART).isin(parts))).items():
            self._replace(df, table, PART, parts)
        there = self._order_parts().where(F.col(BUCKET).isin(buckets)).join(few.select("order_id"), "order_id", "left_anti")
        index = self._bucketed(fresh.select("order_id", PART))
        self._replace(there.select(*index.columns).union(index), "order_parts", BUCKET, buckets)
        return {"orders": n_orders, "buckets": len(buckets), "parts": len(parts)}
