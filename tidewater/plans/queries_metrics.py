"""Registry entries for KPIs, running stock, trends and the salted join."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators import inventory, metrics, salted, timeline, trends
from tidewater.plans.oracle import add_cte, with_ctes
from tidewater.plans.queries import _in, money, rate, register
from tidewater.schemas import INVENTORY, ORDERS, PAYMENTS

RUN_ID = "manual__2024-02-01T00:00:00"

add_cte("order_metrics", ("timeline",), """
SELECT time_bucket(INTERVAL '30 minutes', order_updated_at, TIMESTAMP '1970-01-01') AS window_start,
       time_bucket(INTERVAL '30 minutes', order_updated_at, TIMESTAMP '1970-01-01') + INTERVAL '30 minutes' AS window_end,
       order_status, currency, count(order_id) AS order_count, round(sum(total_amount), 2) AS gross_revenue,
       -- exact: cents in integers, rounded half up to 6 places
       CAST((CAST(sum(CAST(round(total_amount * 100) AS BIGINT)) AS HUGEINT) * 20000 + count(total_amount))
            // (2 * count(total_amount)) AS DOUBLE) / 1000000 AS avg_ticket, quantile_disc(total_amount, 0.5) AS median_ticket,
       quantile_disc(total_amount, 0.95) AS p95_ticket, CAST(sum(items_count) AS BIGINT) AS total_items,
       count(DISTINCT customer_id) AS unique_customers
FROM timeline WHERE order_updated_at IS NOT NULL
GROUP BY ALL""")


def _order_metrics(i):
    m = metrics.order_metrics(i.timeline())
    return (m.withColumn("gross_revenue", money(F.col("gross_revenue")))
            .withColumn("avg_ticket", rate(F.col("avg_ticket"))))


@register("order_metrics", with_ctes("SELECT * FROM order_metrics", "order_metrics"))
def q_order_metrics(spark, sf_dir):
    return _order_metrics(_in(spark, sf_dir))


@register("payment_funnel", with_ctes("""
SELECT payment_method, payment_gateway, payment_status, count(order_id) AS transaction_count,
       round(sum(payment_amount), 2) AS total_amount, round(avg(payment_amount), 6) AS avg_amount,
       CAST(CASE WHEN payment_status = 'approved' THEN 1.0 ELSE 0.0 END AS DOUBLE) AS approval_rate
FROM timeline WHERE payment_status IS NOT NULL GROUP BY ALL""", "timeline"))
def q_payment_funnel(spark, sf_dir):
    f = metrics.payment_funnel(metrics.kpi_cells(_in(spark, sf_dir).timeline()))
    return (f.withColumn("total_amount", money(F.col("total_amount")))
            .withColumn("avg_amount", rate(F.col("avg_amount"))))


@register("approval_rate", with_ctes("""
SELECT payment_method, payment_gateway, count(order_id) AS transaction_count,
       count(*) FILTER (WHERE payment_status = 'approved') AS approved_count,
       round(avg(CASE WHEN payment_status = 'approved' THEN 1.0 ELSE 0.0 END), 6) AS approval_rate
FROM timeline WHERE payment_status IS NOT NULL GROUP BY ALL""", "timeline"))
def q_approval_rate(spark, sf_dir):
    a = metrics.approval_rate(metrics.kpi_cells(_in(spark, sf_dir).timeline()))
    return a.withColumn("approval_rate", rate(F.col("approval_rate")))


@register("sla_metrics", with_ctes("""
SELECT CASE WHEN order_lifecycle_hours <= 24.0 THEN 'within_sla' ELSE 'sla_breached' END AS sla_status, currency,
       count(order_id) AS order_count, round(avg(order_lifecycle_hours), 6) AS avg_fulfillment_hours,
       quantile_disc(order_lifecycle_hours, 0.95) AS p95_fulfillment_hours,
       round(sum(total_amount), 2) AS affected_revenue
FROM timeline WHERE order_lifecycle_hours IS NOT NULL GROUP BY ALL""", "timeline"))
def q_sla_metrics(spark, sf_dir):
    s = metrics.sla_metrics(metrics.kpi_cells(_in(spark, sf_dir).timeline()))
    return (s.withColumn("avg_fulfillment_hours", rate(F.col("avg_fulfillment_hours")))
            .withColumn("affected_revenue", money(F.col("affected_revenue"))))


@register("run_summary", with_ctes(f"""
SELECT '{RUN_ID}' AS run_id, count(*) AS total_records,
       CAST(json_object('run_id', '{RUN_ID}', 'total_records', count(*),
            'metrics_computed', ['order_metrics', 'payment_funnel', 'sla_metrics']) AS VARCHAR) AS summary_json
FROM timeline""", "timeline"))
def q_run_summary(spark, sf_dir):
    return metrics.run_summary(_in(spark, sf_dir).timeline(), RUN_ID)


# ---------------------------------------------------------------- running stock

STOCK_SQL = """
SELECT *, CASE WHEN running_quantity < 10 THEN 'high' WHEN running_quantity < 50 THEN 'medium' ELSE 'low' END
          AS stockout_risk
FROM (SELECT *, CAST(sum(quantity_delta) OVER (PARTITION BY sku, warehouse_id ORDER BY "timestamp") AS BIGINT)
          AS running_quantity FROM valid_inventory)"""


@register("inventory_running", with_ctes(STOCK_SQL, "valid_inventory"))
def q_inventory_running(spark, sf_dir):
    return inventory.inventory_running(_in(spark, sf_dir).valid(INVENTORY))


# ---------------------------------------------------------------- trends

@register("order_status_pivot", with_ctes("""
SELECT time_bucket(INTERVAL '30 minutes', order_updated_at, TIMESTAMP '1970-01-01') AS window_start,
       time_bucket(INTERVAL '30 minutes', order_updated_at, TIMESTAMP '1970-01-01') + INTERVAL '30 minutes' AS window_end,
       count(order_id) FILTER (WHERE order_status = 'pending') AS pending,
       count(order_id) FILTER (WHERE order_status = 'paid') AS paid,
       count(order_id) FILTER (WHERE order_status = 'completed') AS completed,
       count(order_id) FILTER (WHERE coalesce(order_status NOT IN ('pending', 'paid', 'completed'), true)) AS other
FROM timeline WHERE order_updated_at IS NOT NULL GROUP BY ALL""", "timeline"))
def q_order_status_pivot(spark, sf_dir):
    return trends.order_status_pivot(_in(spark, sf_dir).timeline())


@register("order_metrics_trend", with_ctes("""
SELECT window_start, order_status, currency, gross_revenue,
       lag(gross_revenue) OVER w AS prev_value,
       round(gross_revenue - lag(gross_revenue) OVER w, 2) AS value_change,
       round(avg(gross_revenue) OVER (w ROWS BETWEEN 3 PRECEDING AND CURRENT ROW), 6) AS moving_avg
FROM order_metrics
WINDOW w AS (PARTITION BY order_status, currency ORDER BY window_start)""", "order_metrics"))
def q_order_metrics_trend(spark, sf_dir):
    t = trends.order_metrics_trend(_order_metrics(_in(spark, sf_dir)))
    return (t.withColumn("value_change", money(F.col("value_change")))
            .withColumn("moving_avg", rate(F.col("moving_avg"))))


@register("revenue_anomalies", with_ctes("""
SELECT window_start, order_status, currency, gross_revenue, trailing_n,
       round(trailing_mean, 6) AS trailing_mean, round(trailing_std, 6) AS trailing_std,
       round(z, 6) AS z_score, abs(z) > 3.0 AS is_anomaly
FROM (SELECT *, CASE WHEN trailing_n >= 2 AND trailing_std > 0
                     THEN (gross_revenue - trailing_mean) / trailing_std END AS z
      FROM (SELECT window_start, order_status, currency, gross_revenue,
                   count(gross_revenue) OVER t AS trailing_n, avg(gross_revenue) OVER t AS trailing_mean,
                   stddev_samp(gross_revenue) OVER t AS trailing_std
            FROM order_metrics
            WINDOW t AS (PARTITION BY order_status, currency ORDER BY window_start
                         ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)))""", "order_metrics"))
def q_revenue_anomalies(spark, sf_dir):
    a = trends.revenue_anomalies(_order_metrics(_in(spark, sf_dir)))
    return (a.withColumn("trailing_mean", rate(F.col("trailing_mean")))
            .withColumn("trailing_std", rate(F.col("trailing_std")))
            .withColumn("z_score", rate(F.col("z_score"))))


# ---------------------------------------------------------------- salted join

@register("salted_join", with_ctes("""
SELECT o.event_id, o.order_id, o.event_type, o.total_amount, p.payment_id, p.payment_amount, p.payment_status
FROM valid_orders o LEFT JOIN latest_payments p USING (order_id)""", "valid_orders", "latest_payments"))
def q_salted_join(spark, sf_dir):
    i = _in(spark, sf_dir)
    events = i.valid(ORDERS).select("event_id", "order_id", "event_type", "total_amount")
    pay = timeline.payments_latest(i.valid(PAYMENTS)).select("order_id", "payment_id", "payment_amount",
                                                             "payment_status")
    return salted.salted_join(events, pay, "order_id", "event_id", "left")
