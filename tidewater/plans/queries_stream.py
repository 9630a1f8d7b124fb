"""Registry entries for the Structured Streaming twin (M1-M3).

Each query lands the raw order events as JSON Lines in the shared folder, runs
an ``availableNow`` stream over the landing folder (checkpoint in the shared
folder too), and returns what the stream wrote.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.plans.oracle import add_cte, valid_expr, with_ctes
from tidewater.plans.queries import _in, money, register
from tidewater.plans.queries_metrics import STOCK_SQL
from tidewater.schemas import CORRUPT_COL, INVENTORY, ORDERS, schema_for
from tidewater.session import scratch_path
from tidewater.sinks import writers
from tidewater.sources.fixtures import AS_OF
from tidewater.sources.readers import normalise_timestamps
from tidewater.functions.rules import all_pass, rules_for
from tidewater.operators import timeline
from tidewater.streaming import keyed, twin

WATERMARK = "1 hour"


def _landed_orders(spark, sf_dir) -> str:
    root = scratch_path(spark, "stream-landing")
    writers.land_events(_in(spark, sf_dir).raw(ORDERS).withColumn("service", F.lit(ORDERS)), root)
    return writers.landing_path(root, ORDERS)


def _run(spark, stream) -> str:
    out = scratch_path(spark, "stream-out")
    twin.run_available_now(stream, out, scratch_path(spark, "stream-checkpoint"))
    return out


@register("stream_dedup", with_ctes("SELECT * FROM dd_orders", "dd_orders"))
def q_stream_dedup(spark, sf_dir):
    """M1 + M2: the JSON Lines scan as a stream, de-duplicated within the
    horizon of arrival; copies are alike, so this gives the batch dedup's rows."""
    src = _landed_orders(spark, sf_dir)
    out = _run(spark, twin.stream_dedup(twin.stream_service_events(spark, src, ORDERS), WATERMARK)
               .drop(CORRUPT_COL))
    return normalise_timestamps(spark.read.parquet(out))


add_cte("stream_valid_orders", ("fx_orders",), f"SELECT * FROM fx_orders WHERE {valid_expr(ORDERS)}")
add_cte("stream_kpis_all", ("stream_valid_orders",), """
SELECT time_bucket(INTERVAL '30 minutes', "timestamp", TIMESTAMP '1970-01-01') AS window_start,
       status, currency, count(*) AS event_count, round(sum(total_amount), 2) AS revenue
FROM stream_valid_orders GROUP BY ALL""")


# the stream closes a window once the watermark (latest valid event time minus
# the delay) reaches its end; later windows stay open in the state store
@register("stream_order_kpis", with_ctes("""
SELECT window_start, window_start + INTERVAL '30 minutes' AS window_end, status, currency, event_count, revenue
FROM stream_kpis_all
WHERE window_start + INTERVAL '30 minutes' <= (SELECT max("timestamp") - INTERVAL '1 hour' FROM stream_valid_orders)""",
    "stream_valid_orders", "stream_kpis_all"))
def q_stream_order_kpis(spark, sf_dir):
    """M1 + M3: windowed order count and revenue in append mode."""
    src = _landed_orders(spark, sf_dir)
    out = _run(spark, twin.stream_order_kpis(twin.stream_service_events(spark, src, ORDERS), watermark=WATERMARK,
                                             as_of=AS_OF))
    k = normalise_timestamps(spark.read.parquet(out))
    return k.withColumn("revenue", money(F.col("revenue")))


# ---------------------------------------------------------------- F1, F4 as streams

def _deliveries(spark, sf_dir, service, arrival, until):
    """Land the raw events in deliveries by time of ``arrival``, one after the other; yields the landing folder after each."""
    raw = _in(spark, sf_dir).raw(service).withColumn("service", F.lit(service))
    root = scratch_path(spark, "stream-landing")
    for since, end in zip((None, *until), (*until, None)):
        kept = F.lit(True) if since is None else arrival >= F.lit(since).cast("timestamp_ntz")
        part = raw.where(kept if end is None else kept & (arrival < F.lit(end).cast("timestamp_ntz")))
        part.drop("service").write.mode("append").options(**writers.TEXT_TS_OPTIONS).json(f"{root}/{service}")
        yield f"{root}/{service}"


@register("stream_orders_latest", with_ctes("""
SELECT order_id, customer_id, status AS order_status, total_amount, currency, items_count, "timestamp" AS order_updated_at
FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY "timestamp" DESC, event_id DESC) AS _rn
      FROM stream_valid_orders WHERE event_type IN ('ORDER_CREATED', 'ORDER_UPDATED', 'ORDER_COMPLETED'))
WHERE _rn = 1""", "stream_valid_orders"))
def q_stream_orders_latest(spark, sf_dir):
    """F1 as a stream: three deliveries out of order, the stream stopped and started between them."""
    table, checkpoint = None, scratch_path(spark, "stream-checkpoint")
    # an event comes up to twelve hours after its time
    arrival = F.col("timestamp") + F.make_dt_interval(hours=F.pmod(F.xxhash64("order_id", "event_type"), F.lit(13)).cast("int"))
    for src in _deliveries(spark, sf_dir, ORDERS, arrival, ("2024-01-15 18:00:00", "2024-01-16 12:00:00")):
        events = normalise_timestamps(twin.stream_service_events(spark, src, ORDERS)).drop(CORRUPT_COL)
        events = events.filter(all_pass(rules_for(ORDERS, AS_OF, events.columns))
                               & F.col("event_type").isin(*timeline.ORDER_STATE_TYPES))
        table = table or keyed.LatestTable(spark, scratch_path(spark, "latest"), "order_id", events.schema, buckets=16)
        keyed.run_batches(events, table.merge, checkpoint)
    return timeline.orders_latest(table.read())


@register("stream_running_stock", with_ctes(f"""
SELECT * FROM ({STOCK_SQL.replace('FROM valid_inventory', 'FROM fx_inventory')})
WHERE "timestamp" <= (SELECT max("timestamp") FROM fx_inventory) - INTERVAL 30 DAY""", "fx_inventory"))
def q_stream_running_stock(spark, sf_dir):
    """F4 as a stream: events come up to 30 days late in three deliveries; the last 30 days wait in the state."""
    stock, checkpoint = None, scratch_path(spark, "stream-checkpoint")
    arrival = F.col("timestamp") + F.make_dt_interval(days=F.pmod(F.xxhash64("event_id"), F.lit(30)).cast("int"))
    for src in _deliveries(spark, sf_dir, INVENTORY, arrival, ("1994-06-01 00:00:00", "1996-06-01 00:00:00")):
        events = normalise_timestamps(twin.stream_service_events(spark, src, INVENTORY)).drop(CORRUPT_COL)
        stock = stock or keyed.StockStream(spark, scratch_path(spark, "stock"), events.schema, "30 DAYS")
        keyed.run_batches(events, stock.take, checkpoint)
    return stock.out()
