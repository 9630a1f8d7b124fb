"""Per-service event schemas and shared names.

Timestamps are read as ``TimestampType`` (so ISO strings with a ``Z`` offset
parse) and normalised to ``timestamp_ntz`` right after the scan; everything
downstream is zone-free NTZ.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType, LongType, StringType, StructField, StructType, TimestampType,
)

# fixed values: service names
ORDERS = "orders-service"
PAYMENTS = "payments-service"
INVENTORY = "inventory-service"
SHIPPING = "shipping-service"
SERVICES = (ORDERS, PAYMENTS, INVENTORY, SHIPPING)

CORRUPT_COL = "_corrupt_record"

# fixed values: the event fields of each service, in the order the services emit them
_FIELDS = {
    ORDERS: [
        ("event_id", StringType()), ("order_id", StringType()), ("customer_id", StringType()),
        ("event_type", StringType()), ("status", StringType()), ("total_amount", DoubleType()),
        ("currency", StringType()), ("items_count", LongType()), ("timestamp", TimestampType()),
        ("service_version", StringType()),
    ],
    PAYMENTS: [
        ("event_id", StringType()), ("payment_id", StringType()), ("order_id", StringType()),
        ("event_type", StringType()), ("amount", DoubleType()), ("currency", StringType()),
        ("method", StringType()), ("gateway", StringType()), ("status", StringType()),
        ("timestamp", TimestampType()), ("service_version", StringType()),
    ],
    INVENTORY: [
        ("event_id", StringType()), ("sku", StringType()), ("warehouse_id", StringType()),
        ("event_type", StringType()), ("quantity_delta", LongType()), ("quantity_after", LongType()),
        ("timestamp", TimestampType()), ("service_version", StringType()),
    ],
    SHIPPING: [
        ("event_id", StringType()), ("shipment_id", StringType()), ("order_id", StringType()),
        ("event_type", StringType()), ("carrier", StringType()), ("tracking_code", StringType()),
        ("status", StringType()), ("timestamp", TimestampType()), ("service_version", StringType()),
    ],
}

# columns every service shares; the unified log keeps these plus lineage stamps
COMMON_COLUMNS = ("event_id", "event_type", "timestamp")


def schema_for(service: str, with_corrupt: bool = False) -> StructType:
    """Read schema of a service (all fields nullable: readers relax NOT NULL;
    the validation rules enforce it)."""
    if service not in _FIELDS:
        raise KeyError(f"unknown service {service!r}")
    fields = [StructField(n, t, True) for n, t in _FIELDS[service]]
    if with_corrupt:
        fields.append(StructField(CORRUPT_COL, StringType(), True))
    return StructType(fields)


def columns_for(service: str) -> list[str]:
    return [n for n, _ in _FIELDS[service]]
