"""Latest event per order and the three-way order timeline."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.timefns import hours_between

# fixed values: order event types that may define an order's latest state
ORDER_STATE_TYPES = ("ORDER_CREATED", "ORDER_UPDATED", "ORDER_COMPLETED")


def latest_by(df: DataFrame, key: str, keep: dict[str, str],
              order_cols: tuple[str, ...] = ("timestamp", "event_id")) -> DataFrame:
    """Newest row per ``key`` by ``order_cols`` (descending), projected to
    ``keep`` (source column -> output name).

    Written as ``max(struct(order..., kept...))`` grouped by key: a partial
    aggregate runs before the shuffle, so a key holding a third of the rows
    ships one row per map task, and the result comes out hash-partitioned on
    ``key`` for the joins that follow. Ties on every order column fall to the
    larger kept values, so the pick never depends on task timing.
    """
    fields = list(order_cols) + [c for c in keep if c not in order_cols]
    packed = F.struct(*[F.col(c).alias(f"f{i}") for i, c in enumerate(fields)])
    out = df.groupBy(key).agg(F.max(packed).alias("_top"))
    pos = {c: i for i, c in enumerate(fields)}
    return out.select(F.col(key), *[F.col(f"_top.f{pos[src]}").alias(dst) for src, dst in keep.items()])


def orders_latest(orders: DataFrame) -> DataFrame:
    return latest_by(
        orders.filter(F.col("event_type").isin(*ORDER_STATE_TYPES)),
        "order_id",
        {"customer_id": "customer_id", "status": "order_status", "total_amount": "total_amount",
         "currency": "currency", "items_count": "items_count", "timestamp": "order_updated_at"},
    )


def payments_latest(payments: DataFrame) -> DataFrame:
    return latest_by(
        payments, "order_id",
        {"payment_id": "payment_id", "status": "payment_status", "method": "payment_method",
         "gateway": "payment_gateway", "amount": "payment_amount", "timestamp": "payment_updated_at"},
    )


def shipping_latest(shipping: DataFrame) -> DataFrame:
    return latest_by(
        shipping, "order_id",
        {"shipment_id": "shipment_id", "status": "shipping_status", "carrier": "carrier",
         "tracking_code": "tracking_code", "timestamp": "shipping_updated_at"},
    )


def payment_match(total: str = "total_amount", paid: str = "payment_amount"):
    """NULL without a payment, else |total - paid| < 0.01."""
    return F.when(F.col(paid).isNotNull(), F.abs(F.col(total) - F.col(paid)) < F.lit(0.01))


def lifecycle_hours(order_ts: str = "order_updated_at", ship_ts: str = "shipping_updated_at"):
    """Whole-second gap shipment - last order update, in hours; NULL if unshipped."""
    return F.when(F.col(ship_ts).isNotNull(), hours_between(F.col(order_ts), F.col(ship_ts)))


def _join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join on ``order_id``.  No broadcast hint: the right side is
    fact-sized (about one row per order); Spark broadcasts it only when its
    size estimate - or AQE's measurement at run time - is under the
    broadcast threshold."""
    return left.join(right, on="order_id", how="left")


def orders_with_payments(orders_l: DataFrame, payments_l: DataFrame) -> DataFrame:
    return _join(orders_l, payments_l)


def orders_with_shipping(orders_l: DataFrame, shipping_l: DataFrame) -> DataFrame:
    return _join(orders_l, shipping_l)


def order_timeline(orders: DataFrame, payments: DataFrame, shipping: DataFrame,
                   stamp: bool = False) -> DataFrame:
    """One row per order with its latest state, payment and shipment.

    The three ``latest`` aggregates are all hash-partitioned on ``order_id``,
    so the two left joins are sort-merge joins that reuse those partitions
    (no further exchange), unless a side is measured small enough to
    broadcast.
    """
    enriched = _join(_join(orders_latest(orders), payments_latest(payments)), shipping_latest(shipping))
    enriched = (enriched.withColumn("payment_match", payment_match())
                .withColumn("order_lifecycle_hours", lifecycle_hours()))
    if stamp:
        enriched = enriched.withColumn("_enriched_at", F.localtimestamp())
    return enriched
