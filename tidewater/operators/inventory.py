"""Running stock per SKU and warehouse.

Semantics: ``sum(quantity_delta) OVER (PARTITION BY sku, warehouse_id ORDER BY
timestamp)`` with the default RANGE frame, i.e. rows sharing a timestamp share
one running total.  A plain window puts each (sku, warehouse) in one task; a
key can hold a third of all rows, so:

1. per (key, timestamp) totals - a partial aggregate, so any pile-up of rows
   on one instant collapses map-side (this is also where RANGE ties merge,
   and what makes (key, timestamp) unique for step 2);
2. a running sum over those rows, sliced by time so a hot key is spread over
   many tasks (:func:`tidewater.operators.prefix.sliced_running_sums`);
3. the running value joined back to the events on (key, timestamp) - AQE
   splits skewed partitions of this join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators.prefix import null_safe_join, sliced_running_sums

KEYS = ("sku", "warehouse_id")

# fixed values: stockout risk is high below 10 units, medium below 50
HIGH_RISK_BELOW = 10
MEDIUM_RISK_BELOW = 50


def running_totals(events: DataFrame, keys=KEYS, ts: str = "timestamp",
                   value: str = "quantity_delta", width: str | None = None) -> DataFrame:
    """(keys..., ts, running) with one row per distinct (keys, ts).

    ``width`` is the time unit of a slice (default hour).  NULL deltas are skipped like ``sum``
    skips them; the total stays NULL until the first non-NULL delta.
    """
    keys = list(keys)
    per_ts = events.groupBy(*keys, ts).agg(F.sum(value).alias("_d"), F.count(value).alias("_c"))
    run = sliced_running_sums(per_ts, keys, [ts], {"_q": F.col("_d"), "_n": F.col("_c")}, width)
    return run.select(*keys, ts, F.when(F.col("_n") > 0, F.col("_q")).alias("running_quantity"))


def stockout_risk(col: str = "running_quantity"):
    """< 10 high, < 50 medium, else low (a NULL total falls to low)."""
    return (F.when(F.col(col) < HIGH_RISK_BELOW, "high").when(F.col(col) < MEDIUM_RISK_BELOW, "medium")
            .otherwise("low"))


def inventory_running(inventory: DataFrame, width: str | None = None) -> DataFrame:
    """Every inventory event with its running stock and stockout risk."""
    totals = running_totals(inventory, width=width)
    out = null_safe_join(inventory, totals, list(KEYS) + ["timestamp"], "left")
    return out.withColumn("stockout_risk", stockout_risk())
