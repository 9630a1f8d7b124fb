"""Priority-scoped collection (K3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.schemas import INVENTORY, ORDERS, PAYMENTS, SHIPPING

# fixed values: the service registry's static fallback (name, priority)
SERVICE_PRIORITIES = (
    (ORDERS, "high"),
    (INVENTORY, "high"),
    (PAYMENTS, "critical"),
    (SHIPPING, "medium"),
)
DEFAULT_PRIORITY = "medium"
PARTIAL_PRIORITIES = ("critical", "high")


def service_table(spark: SparkSession, rows=SERVICE_PRIORITIES) -> DataFrame:
    return spark.createDataFrame(list(rows), "name string, priority string")


def priority_scope(events: DataFrame, services: DataFrame, priorities=PARTIAL_PRIORITIES,
                   service_col: str = "_service") -> DataFrame:
    """Events of services whose priority is in ``priorities`` (a service missing
    from the table, or without a priority, counts as medium).

    A join with the wanted services; where the default priority is wanted too,
    the rows without an unwanted one, so that services the table lacks stay in.
    """
    priority = F.coalesce("priority", F.lit(DEFAULT_PRIORITY)).isin(*priorities)
    keeps_unknown = DEFAULT_PRIORITY in priorities
    named = services.filter(~priority if keeps_unknown else priority).select(F.col("name").alias("_name")).distinct()
    joined = events.join(named, events[service_col] == named["_name"], "left" if keeps_unknown else "inner")
    return (joined.filter(F.col("_name").isNull()) if keeps_unknown else joined).drop("_name")
