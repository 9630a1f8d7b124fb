"""Dense time series: a calendar of windows, and frames over time.

``trends.py`` looks back over the windows that are there, so after a gap the previous value
and a trailing span reach further back than they say.  Here each series gets a row
for every window from its first to the last one of all series; a window without orders counts 0, and frames are
stretches of time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.timefns import minutes

SERIES = ("order_status", "currency")


def dense_series(kpis: DataFrame, window: str = "30 minutes", series=SERIES, value: str = "gross_revenue") -> DataFrame:
    """(window_start, series..., value, present): one row per series and window of the calendar.

    A series begins with its first window; the calendar ends with the last window of any series.  The rows that are
    made are windows x series, whatever the number of orders.  Rows without a window are left out.
    """
    step = F.expr(f"INTERVAL {minutes(window)} MINUTES")
    there = kpis.where(F.col("window_start").isNotNull()).select("window_start", *series, value)
    spans = there.groupBy(*series).agg(F.min("window_start").alias("_from"))
    end = there.agg(F.max("window_start")).scalar()
    calendar = spans.select(*series, F.explode(F.sequence(F.col("_from"), end, step)).alias("window_start"))
    slots = calendar.select("window_start", *series, F.lit(None).cast(there.schema[value].dataType).alias(value), F.lit(0).alias("_there"))
    both = slots.unionByName(there.withColumn("_there", F.lit(1)))
    return both.groupBy("window_start", *series).agg(
        F.coalesce(F.sum(value), F.lit(0.0)).alias(value), (F.max("_there") == 1).alias("present"))


def _span(series, first: int, last: int):
    """A frame from ``first`` to ``last`` minutes relative to the row's window, which it may not reach."""
    return Window.partitionBy(*series).orderBy(F.unix_seconds(F.col("window_start").cast("timestamp"))).rangeBetween(60 * first, 60 * last)


def dense_trend(kpis: DataFrame, window: str = "30 minutes", windows: int = 4, series=SERIES,
                value: str = "gross_revenue") -> DataFrame:
    """Value of the window just before (NULL for a series' first), the change, and the average of the last ``windows`` windows."""
    m, own = minutes(window), dense_series(kpis, window, series, value)
    previous = F.sum(value).over(_span(series, -m, -m))
    return own.withColumn("prev_value", previous).select(
        "window_start", *series, value, "present", "prev_value", (F.col(value) - F.col("prev_value")).alias("value_change"),
        F.avg(value).over(_span(series, -m * (windows - 1), 0)).alias("moving_avg"))


def dense_anomalies(kpis: DataFrame, window: str = "30 minutes", windows: int = 12, limit: float = 3.0, series=SERIES,
                    value: str = "gross_revenue") -> DataFrame:
    """z-score against the ``windows`` windows of time before (empty ones count 0); NULL for fewer than 2 or no spread."""
    m, own = minutes(window), dense_series(kpis, window, series, value)
    trailing = _span(series, -m * windows, -m)
    out = own.withColumns({"trailing_n": F.count(value).over(trailing), "trailing_mean": F.avg(value).over(trailing),
                           "trailing_std": F.stddev_samp(value).over(trailing)})
    z = F.when((F.col("trailing_n") >= 2) & (F.col("trailing_std") > 0),
               (F.col(value) - F.col("trailing_mean")) / F.col("trailing_std"))
    return out.withColumn("z_score", z).withColumn("is_anomaly", F.abs("z_score") > limit)
