"""Time-series views over the windowed KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.timefns import minutes

# fixed values: order states shown as pivot columns
ORDER_STATES = ("pending", "paid", "completed")


def order_status_pivot(enriched: DataFrame, window: str = "30 minutes",
                       states=ORDER_STATES) -> DataFrame:
    """Orders per window with one count column per state (0 when none), those in
    any other state (or none) in ``other``.  The state list is given, so no
    extra job is run to discover it."""
    w = F.window("order_updated_at", f"{minutes(window)} minutes")
    state = F.when(F.col("order_status").isin(*states), F.col("order_status")).otherwise("other")
    out = (enriched.withColumn("_state", state).groupBy(w.alias("time_window"))
           .pivot("_state", [*states, "other"])
           .agg(F.count("order_id")))
    return out.select(F.col("time_window.start").alias("window_start"),
                      F.col("time_window.end").alias("window_end"),
                      *[F.coalesce(F.col(s), F.lit(0)).alias(s) for s in (*states, "other")])


def _series(keys=("order_status", "currency"), order: str = "window_start"):
    return Window.partitionBy(*keys).orderBy(order)


def order_metrics_trend(metrics: DataFrame, value: str = "gross_revenue", span: int = 4) -> DataFrame:
    """Previous window's value, the change, and a moving average over the last
    ``span`` windows (current included), per status x currency series.
    Runs on the aggregated KPI table (keys x windows rows)."""
    w = _series()
    return (metrics.select("window_start", "order_status", "currency", value)
            .withColumn("prev_value", F.lag(value).over(w))
            .withColumn("value_change", F.col(value) - F.col("prev_value"))
            .withColumn("moving_avg", F.avg(value).over(w.rowsBetween(-(span - 1), 0))))


def revenue_anomalies(metrics: DataFrame, value: str = "gross_revenue", trailing: int = 12,
                      z_limit: float = 3.0) -> DataFrame:
    """z-score of each window against the ``trailing`` windows before it
    (current excluded); NULL with fewer than 2 of them or zero spread."""
    t = _series().rowsBetween(-trailing, -1)
    out = (metrics.select("window_start", "order_status", "currency", value)
           .withColumn("trailing_n", F.count(value).over(t))
           .withColumn("trailing_mean", F.avg(value).over(t))
           .withColumn("trailing_std", F.stddev_samp(value).over(t)))
    z = F.when((F.col("trailing_n") >= 2) & (F.col("trailing_std") > 0),
               (F.col(value) - F.col("trailing_mean")) / F.col("trailing_std"))
    return (out.withColumn("z_score", z)
            .withColumn("is_anomaly", F.abs(F.col("z_score")) > F.lit(z_limit)))
