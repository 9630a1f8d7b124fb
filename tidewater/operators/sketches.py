"""Order KPIs as mergeable sketches.

One aggregate per window x status x currency holds counts, sums, a KLL sketch of the
ticket amounts and a theta sketch of the customers, as binary columns.  Stored once, they merge
into hours and days without the orders being read again, and customers of several windows
can be united and intersected.  Customers need no second aggregate, unlike the exact count of metrics.py, which
stays for whom needs it.

Error bounds.  KLL: a quantile's rank is off by at most 2.296 / k ** 0.9723 of the group's rows with 99 % confidence, merged or not
(0.0723 % for k = 4,000); groups of fewer than about k rows are exact.  Theta: the relative standard error of a count is
1 / sqrt(2 ** lg_k) (0.39 % for lg_k = 16); below 2 ** lg_k customers it is exact.  The error of an intersection is that
share of the union, not of the intersection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.timefns import minutes

KLL_K, THETA_LG_K = 4000, 16
GROUP = ("order_status", "currency")


def rank_error(k: int = KLL_K) -> float:
    """Share of a group's rows by which a quantile's rank may be off, with 99 % confidence."""
    return 2.296 / k ** 0.9723


def distinct_error(lg_k: int = THETA_LG_K) -> float:
    """Relative standard error of a distinct count."""
    return 2 ** (-lg_k / 2)


def kpi_sketches(enriched: DataFrame, window: str = "30 minutes", k: int = KLL_K, lg_k: int = THETA_LG_K) -> DataFrame:
    """One row per window x status x currency: counts, sums and sketches, in one pass and one exchange.

    Orders without a time belong to no window; a NULL amount or customer is in no sketch.
    """
    span = F.window("order_updated_at", f"{minutes(window)} minutes")
    return (enriched.where(F.col("order_updated_at").isNotNull())
            .groupBy(span["start"].alias("window_start"), *GROUP)
            .agg(F.count("order_id").alias("order_count"), F.count("total_amount").alias("tickets"),
                 F.sum(F.col("total_amount").cast("decimal(18,2)")).alias("revenue"),
                 F.sum("items_count").alias("total_items"),
                 F.kll_sketch_agg_double("total_amount", k).alias("amounts"),
                 F.theta_sketch_agg("customer_id", lg_k).alias("customers")))


def merge(sketches: DataFrame, keys: dict[str, Column], k: int = KLL_K, lg_k: int = THETA_LG_K) -> DataFrame:
    """Sketches of the rows that share ``keys`` become one: longer windows, fewer groups, or both."""
    return sketches.groupBy(*[c.alias(n) for n, c in keys.items()]).agg(
        *[F.sum(c).alias(c) for c in ("order_count", "tickets", "revenue", "total_items")],
        F.kll_merge_agg_double("amounts", k).alias("amounts"), F.theta_union_agg("customers", lg_k).alias("customers"))


def roll_up(sketches: DataFrame, unit: str, k: int = KLL_K, lg_k: int = THETA_LG_K) -> DataFrame:
    """``unit``: hour, day, week or any other of ``date_trunc``."""
    start = F.date_trunc(unit, "window_start").cast(sketches.schema["window_start"].dataType)
    keys = {"window_start": start} | {g: F.col(g) for g in GROUP}
    return merge(sketches, keys, k, lg_k)


def quantile(sketch: str, share: float) -> Column:
    """NULL for a sketch without values."""
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(share)))


def finished(sketches: DataFrame) -> DataFrame:
    """The KPI columns of sketches, whatever their windows."""
    own = [c for c in sketches.columns if c in ("window_start", *GROUP)]
    average = F.try_divide("revenue", "tickets").cast("decimal(38,12)").cast("double")
    return sketches.select(
        *own, "order_count", F.col("revenue").cast("double").alias("gross_revenue"), average.alias("avg_ticket"),
        quantile("amounts", 0.5).alias("median_ticket"), quantile("amounts", 0.95).alias("p95_ticket"), "total_items",
        F.theta_sketch_estimate("customers").alias("unique_customers"))


def customer_retention(sketches: DataFrame, hours: int, lg_k: int = THETA_LG_K) -> DataFrame:
    """Per window of ``hours`` hours: its customers, those of the window before, and of both together.

    The window before is the one that ends where this begins; where it has no orders it has no customers.
    """
    width = f"{hours} hours"
    whole = merge(sketches, {"window_start": F.window("window_start", width)["start"]}, lg_k=lg_k)
    whole = whole.select("window_start", "customers")
    before = whole.select((F.col("window_start") + F.expr(f"INTERVAL {hours} HOURS")).alias("window_start"),
                          F.col("customers").alias("_before"))
    both = F.when(F.col("_before").isNotNull(), F.theta_sketch_estimate(F.theta_intersection("customers", "_before")))
    return whole.join(before, "window_start", "left").select(
        "window_start", F.theta_sketch_estimate("customers").alias("customers"),
        F.coalesce(F.when(F.col("_before").isNotNull(), F.theta_sketch_estimate("_before")), F.lit(0).cast("long")).alias("customers_before"),
        F.coalesce(both, F.lit(0).cast("long")).alias("retained"))
