"""Paged export envelopes -> events (K1) and the collection summary (K2).

A landed page is (service, page, body) where body is the JSON envelope a
service's export endpoint returns: ``{"events": [...]}`` or ``{"items": [...]}``
plus ``has_next`` and ``total``.  Collection reads pages 1, 2, ... and stops at
the first page that has ``has_next`` false or fewer than ``limit`` events (that
page is kept); an unparsable page before the stop fails the whole service.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BooleanType, DoubleType, LongType, StringType, StructField, StructType, TimestampNTZType,
)

from tidewater.operators.prefix import sliced_running_sums

EXPORT_EVENT = StructType([
    StructField("event_id", LongType()), StructField("ts", TimestampNTZType()),
    StructField("user_id", LongType()), StructField("event_type", StringType()),
    StructField("value", DoubleType()),
])


# timestamps travel through JSON with all six fractional digits
JSON_TS_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
                   "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def envelope_schema(event: StructType = EXPORT_EVENT) -> StructType:
    return StructType([
        StructField("events", ArrayType(event)), StructField("items", ArrayType(event)),
        StructField("has_next", BooleanType()), StructField("total", LongType()),
        StructField("_corrupt_record", StringType()),
    ])


def _pages_state(pages: DataFrame, limit: int, event: StructType) -> DataFrame:
    doc = F.from_json(F.col("body"), envelope_schema(event),
                      {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    return (pages.withColumn("_doc", doc)
            .withColumn("_ok", F.col("_doc").isNotNull() & F.col("_doc._corrupt_record").isNull())
            .withColumn("_events", F.coalesce(F.col("_doc.events"), F.col("_doc.items"),
                                              F.array().cast(ArrayType(event))))
            .withColumn("_last", ~F.col("_ok") | ~F.coalesce(F.col("_doc.has_next"), F.lit(False))
                        | (F.size("_events") < F.lit(limit))))


def _stops(state: DataFrame) -> DataFrame:
    """Per service: the first page that ends collection and whether it parsed.
    A grouped min, so a service with millions of pages is still one partial
    aggregate per map task."""
    first = F.min(F.when(F.col("_last"), F.struct(F.col("page").alias("page"), F.col("_ok").alias("ok"))))
    return (state.groupBy("service").agg(first.alias("_stop"), F.count(F.lit(1)).alias("_landed"))
            .select("service", F.col("_stop.page").alias("_stop_page"),
                    F.coalesce(F.col("_stop.ok"), F.lit(True)).alias("_stop_ok"), "_landed"))


def unpage_export(pages: DataFrame, limit: int, event: StructType = EXPORT_EVENT) -> DataFrame:
    """Events of every successfully collected service (page <= stop page)."""
    state = _pages_state(pages, limit, event)
    kept = (state.join(_stops(state), "service")
            .filter(F.col("_stop_ok") & (F.col("_stop_page").isNull() | (F.col("page") <= F.col("_stop_page")))))
    return kept.select("service", "page", F.explode("_events").alias("e")).select("service", "page", "e.*")


def collection_summary(pages: DataFrame, limit: int, event: StructType = EXPORT_EVENT) -> DataFrame:
    """Per service: success/failed, events collected, pages fetched; plus a
    grand-total row (service NULL) with services collected / failed."""
    state = _pages_state(pages, limit, event)
    per_page = (state.join(_stops(state), "service")
                .filter(F.col("_stop_page").isNull() | (F.col("page") <= F.col("_stop_page")))
                .select("service", "page", "_stop_ok", F.size("_events").alias("_n")))
    per_service = (per_page.groupBy("service")
                   .agg(F.bool_and("_stop_ok").alias("_ok"), F.sum("_n").alias("_n"),
                        F.max("page").alias("_pages"))
                   .select("service",
                           F.when(F.col("_ok"), F.col("_n")).otherwise(F.lit(0).cast("long")).alias("event_count"),
                           F.when(F.col("_ok"), F.col("_pages")).alias("pages_fetched"),
                           F.col("_ok").cast("long").alias("collected"),
                           (~F.col("_ok")).cast("long").alias("failed")))
    return (per_service.rollup("service")
            .agg(F.sum("event_count").alias("event_count"), F.sum("pages_fetched").alias("pages_fetched"),
                 F.sum("collected").alias("services_collected"), F.sum("failed").alias("services_failed")))


def position_in_group(df: DataFrame, keys: list[str], order: str, width: int | str | None = None) -> DataFrame:
    """1-based rank ``_pos`` of each row within ``keys`` by ``order`` (unique
    per key): a running count over slices, so a key with a third of
    the rows is spread over many tasks."""
    return sliced_running_sums(df, list(keys), [order], {"_pos": F.lit(1)}, width)
