"""Service event streams derived from the test tables.

One SQL text per fixture runs unchanged in Spark SQL and DuckDB: on the Spark
side the ``{table}`` slots are bound to DataFrames (``spark.sql(text, t=df)``),
on the DuckDB side they become CTE names.  ``TS`` is the NTZ literal keyword.
Planted faults: duplicate deliveries, NULL ids, empty types, NULL / negative /
zero amounts, future times, an event type that must not win "latest", bad
currency, missing payments and shipments, and inventory ids that repeat with
different content.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewater.schemas import INVENTORY, ORDERS, PAYMENTS, SHIPPING
from tidewater.sources.readers import deal_out_small

# the point in time that stands in for "now" in every fixture query
AS_OF = "2024-02-01 00:00:00"

FX_SQL: dict[str, str] = {
    "fx_base": """
SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS st, o_totalprice AS amt,
       CASE o_custkey % 4 WHEN 0 THEN 'BRL' WHEN 1 THEN 'USD' WHEN 2 THEN 'EUR' ELSE 'GBP' END AS cur,
       TS '2024-01-15 00:00:00' + INTERVAL '1' MINUTE * (o_orderkey % 2880) AS t
FROM {orders}
""",
    "fx_orders": """
SELECT CASE WHEN k % 61 = 60 AND seq = 1 THEN NULL ELSE 'evt_' || CAST(k AS STRING) || '_' || CAST(seq AS STRING) END AS event_id,
       'ord_' || CAST(k AS STRING) AS order_id, 'cust_' || CAST(c AS STRING) AS customer_id,
       CASE WHEN k % 53 = 52 AND seq = 1 THEN '' ELSE event_type END AS event_type, status,
       CASE WHEN k % 37 = 36 AND seq = 1 THEN NULL WHEN k % 41 = 40 AND seq = 1 THEN -amt ELSE amt END AS total_amount,
       cur AS currency, k % 10 + 1 AS items_count,
       CASE WHEN k % 59 = 58 AND seq = 1 THEN t + INTERVAL '3650' DAY ELSE t + INTERVAL '1' HOUR * off END AS timestamp,
       '1.2.3' AS service_version
FROM (
  SELECT *, 1 AS seq, 0 AS off, 'ORDER_CREATED' AS event_type, 'pending' AS status FROM {fx_base}
  UNION ALL SELECT *, 1, 0, 'ORDER_CREATED', 'pending' FROM {fx_base} WHERE k % 20 = 0
  UNION ALL SELECT *, 2, 2, 'ORDER_UPDATED', 'paid' FROM {fx_base} WHERE k % 3 = 0
  UNION ALL SELECT *, 3, 5, 'ORDER_COMPLETED', 'completed' FROM {fx_base} WHERE st = 'F'
  UNION ALL SELECT *, 4, 6, 'ORDER_CANCELLED', 'cancelled' FROM {fx_base} WHERE k % 11 = 0
) x
""",
    "fx_payments": """
SELECT 'pay_evt_' || CAST(k AS STRING) || '_' || CAST(seq AS STRING) AS event_id, 'pay_' || CAST(k AS STRING) AS payment_id,
       'ord_' || CAST(k AS STRING) AS order_id, 'PAYMENT_PROCESSED' AS event_type,
       CASE WHEN k % 83 = 82 THEN NULL WHEN k % 89 = 88 THEN 0.0 WHEN k % 7 = 0 THEN amt + 5.0 ELSE amt END AS amount,
       CASE WHEN k % 97 = 96 THEN 'JPY' ELSE cur END AS currency,
       CASE k % 3 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'pix' ELSE 'boleto' END AS method,
       CASE k % 2 WHEN 0 THEN 'stripe' ELSE 'adyen' END AS gateway, status,
       t + INTERVAL '1' MINUTE * off AS timestamp, '2.0.1' AS service_version
FROM (
  SELECT *, 1 AS seq, 1 AS off, CASE WHEN k % 4 = 0 THEN 'declined' ELSE 'approved' END AS status FROM {fx_base} WHERE k % 10 <> 9
  UNION ALL SELECT *, 2, 10, 'approved' FROM {fx_base} WHERE k % 10 <> 9 AND k % 8 = 0
) x
""",
    "fx_inventory": """
SELECT 'inv_evt_' || CAST(l_orderkey AS STRING) || '_' || CAST(l_linenumber AS STRING) AS event_id,
       'SKU-' || CAST(l_partkey % 20 AS STRING) AS sku, 'WH-' || CAST(l_suppkey % 3 + 1 AS STRING) AS warehouse_id,
       'STOCK_UPDATED' AS event_type,
       CAST(floor(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE -l_quantity / 2 END) AS BIGINT) AS quantity_delta,
       CAST(NULL AS BIGINT) AS quantity_after, l_shipdate AS timestamp, '1.5.0' AS service_version
FROM {lineitem}
""",
    "fx_shipping": """
SELECT 'ship_evt_' || CAST(k AS STRING) AS event_id, 'ship_' || CAST(k AS STRING) AS shipment_id,
       'ord_' || CAST(k AS STRING) AS order_id, 'SHIPMENT_DISPATCHED' AS event_type,
       CASE k % 3 WHEN 0 THEN 'correios' WHEN 1 THEN 'fedex' ELSE 'jadlog' END AS carrier,
       'TR' || CAST(k AS STRING) || 'BR' AS tracking_code, 'in_transit' AS status,
       t + INTERVAL '1' HOUR * (k % 49) AS timestamp, '1.1.2' AS service_version
FROM {fx_base} WHERE k % 9 <> 8
""",
}

# Single-scan forms of the multi-variant fixtures: the variants of one base row
# are generated from a list instead of a UNION ALL of filtered scans (same rows).
_SPARK_VARIANTS = {
    "fx_orders": ("""  SELECT b.*, v.seq, v.off, v.event_type, v.status FROM {fx_base} b
  LATERAL VIEW inline(array(
    named_struct('seq', 1, 'off', 0, 'event_type', 'ORDER_CREATED', 'status', 'pending', 'keep', true),
    named_struct('seq', 1, 'off', 0, 'event_type', 'ORDER_CREATED', 'status', 'pending', 'keep', k % 20 = 0),
    named_struct('seq', 2, 'off', 2, 'event_type', 'ORDER_UPDATED', 'status', 'paid', 'keep', k % 3 = 0),
    named_struct('seq', 3, 'off', 5, 'event_type', 'ORDER_COMPLETED', 'status', 'completed', 'keep', st = 'F'),
    named_struct('seq', 4, 'off', 6, 'event_type', 'ORDER_CANCELLED', 'status', 'cancelled', 'keep', k % 11 = 0)
  )) v
  WHERE v.keep"""),
    "fx_payments": ("""  SELECT b.*, v.seq, v.off, v.status FROM {fx_base} b
  LATERAL VIEW inline(array(
    named_struct('seq', 1, 'off', 1, 'status', CASE WHEN k % 4 = 0 THEN 'declined' ELSE 'approved' END,
                 'keep', k % 10 <> 9),
    named_struct('seq', 2, 'off', 10, 'status', 'approved', 'keep', k % 10 <> 9 AND k % 8 = 0)
  )) v
  WHERE v.keep"""),
}

#: Keys that small tables are dealt out by.
_DEALT_BY = {"orders": "o_orderkey", "lineitem": "l_orderkey", "events": "event_id"}


def read_base_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table; a small one, which is a single row group and would be one task, is dealt out over the cores."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return deal_out_small(df, _DEALT_BY[name]) if name in _DEALT_BY else df


# which base tables / fixtures each fixture reads
_DEPS = {
    "fx_base": ("orders",),
    "fx_orders": ("fx_base",),
    "fx_payments": ("fx_base",),
    "fx_inventory": ("lineitem",),
    "fx_shipping": ("fx_base",),
}

SERVICE_FIXTURE = {ORDERS: "fx_orders", PAYMENTS: "fx_payments",
                   INVENTORY: "fx_inventory", SHIPPING: "fx_shipping"}


def _spark_text(name: str) -> str:
    text = FX_SQL[name]
    if name in _SPARK_VARIANTS:
        head, rest = text.split("FROM (\n", 1)
        text = head + "FROM (\n" + _SPARK_VARIANTS[name] + "\n) x\n"
    return text.replace("TS '", "TIMESTAMP_NTZ '")


_DUCK_VARIANTS = {
    "fx_orders": """  SELECT * EXCLUDE (v), v.seq AS seq, v.off AS off, v.event_type AS event_type, v.status AS status
  FROM (SELECT *, unnest([
    {{'seq': 1, 'off': 0, 'event_type': 'ORDER_CREATED', 'status': 'pending', 'keep': true}},
    {{'seq': 1, 'off': 0, 'event_type': 'ORDER_CREATED', 'status': 'pending', 'keep': k % 20 = 0}},
    {{'seq': 2, 'off': 2, 'event_type': 'ORDER_UPDATED', 'status': 'paid', 'keep': k % 3 = 0}},
    {{'seq': 3, 'off': 5, 'event_type': 'ORDER_COMPLETED', 'status': 'completed', 'keep': st = 'F'}},
    {{'seq': 4, 'off': 6, 'event_type': 'ORDER_CANCELLED', 'status': 'cancelled', 'keep': k % 11 = 0}}
  ]) AS v FROM {fx_base}) WHERE v.keep""",
    "fx_payments": """  SELECT * EXCLUDE (v), v.seq AS seq, v.off AS off, v.status AS status
  FROM (SELECT *, unnest([
    {{'seq': 1, 'off': 1, 'status': CASE WHEN k % 4 = 0 THEN 'declined' ELSE 'approved' END, 'keep': k % 10 <> 9}},
    {{'seq': 2, 'off': 10, 'status': 'approved', 'keep': k % 10 <> 9 AND k % 8 = 0}}
  ]) AS v FROM {fx_base}) WHERE v.keep""",
}


def _duck_text(name: str) -> str:
    text = FX_SQL[name]
    if name in _DUCK_VARIANTS:
        text = text.split("FROM (\n", 1)[0] + "FROM (\n" + _DUCK_VARIANTS[name] + "\n) x\n"
    text = text.replace("TS '", "TIMESTAMP '")
    return text.format(**{d: d for d in ("orders", "lineitem", "fx_base")})


class Fixtures:
    """Lazily built fixture DataFrames over one test-data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            if name in FX_SQL:
                deps = {d: self.table(d) for d in _DEPS[name]}
                self._cache[name] = self.spark.sql(_spark_text(name), **deps)
            else:
                df = read_base_table(self.spark, self.sf_dir, name)
                self._cache[name] = df
        return self._cache[name]

    def service(self, service: str) -> DataFrame:
        return self.table(SERVICE_FIXTURE[service])
