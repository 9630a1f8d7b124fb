"""Registry entries for the operations operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators import ops, recovery, scope
from tidewater.plans.oracle import add_cte, with_ctes
from tidewater.plans.queries import _in, rate, register
from tidewater.plans.queries_metrics import RUN_ID, _order_metrics
from tidewater.schemas import INVENTORY, ORDERS, PAYMENTS, SHIPPING
from tidewater.session import scratch_path
from tidewater.sinks.publish import publish_payloads
from tidewater.sinks.writers import write_table
from tidewater.sources.derived import OPS_DEPS, duck_ops_text, spark_ops_table
from tidewater.sources.export import JSON_TS_OPTIONS, collection_summary, position_in_group, unpage_export

for _name in ("fx_readings", "fx_logs", "fx_stages", "fx_executors", "fx_tasks", "fx_recovered"):
    add_cte(_name, OPS_DEPS[_name], duck_ops_text(_name))

# ---------------------------------------------------------------- K1 / K2: paged export

PAGE_LIMIT = 50
NOTIFICATIONS = "notifications-service"
# fixed values: landing services in the order user_id % 5 picks them
EXPORT_SERVICES = (ORDERS, INVENTORY, PAYMENTS, SHIPPING, NOTIFICATIONS)


def export_pages(events, limit: int = PAGE_LIMIT):
    """``events`` as paged export envelopes: service = user_id % 5, pages of
    ``limit`` by event_id; shipping loses its error events on the page four fifths
    in (an early short page), inventory answers with ``items``, and the page halfway
    through the notifications service is cut off mid-document (unparsable)."""
    svc = F.element_at(F.array(*[F.lit(s) for s in EXPORT_SERVICES]), (F.col("user_id") % 5 + 1).cast("int"))
    ev = events.select("event_id", "ts", "user_id", "event_type", "value").withColumn("service", svc)
    ranked = position_in_group(ev, ["service"], "event_id")
    paged = ranked.withColumn("page", F.floor((F.col("_pos") - 1) / F.lit(limit)).cast("long") + 1).drop("_pos")
    grouped = (paged.groupBy("service", "page")
               .agg(F.collect_list(F.struct("event_id", "ts", "user_id", "event_type", "value")).alias("evs")))
    last = grouped.groupBy("service").agg(F.max("page").alias("_max"))
    pages = grouped.join(last, "service").withColumn("has_next", F.col("page") < F.col("_max"))
    short = (F.col("service") == SHIPPING) & (F.col("page") == F.floor(F.col("_max") * 4 / 5) + 1)
    pages = (pages.withColumn("evs", F.when(short, F.filter("evs", lambda e: e["event_type"] != "error")).otherwise(F.col("evs")))
             .withColumn("total", F.size("evs").cast("long")))
    as_items = F.to_json(F.struct(F.col("evs").alias("items"), "has_next", "total"), JSON_TS_OPTIONS)
    as_events = F.to_json(F.struct(F.col("evs").alias("events"), "has_next", "total"), JSON_TS_OPTIONS)
    body = F.when(F.col("service") == INVENTORY, as_items).otherwise(as_events)
    cut = (F.col("service") == NOTIFICATIONS) & (F.col("page") == F.floor(F.col("_max") / 2) + 1)
    return pages.select("service", "page", F.when(cut, F.substring(body, 1, 40)).otherwise(body).alias("body"))


def _landed_pages(spark, sf_dir):
    """The pages as a collector lands them: written once to the shared folder."""
    path = scratch_path(spark, "export-pages")
    write_table(export_pages(spark.read.parquet(f"{sf_dir}/events.parquet")), path)
    return spark.read.schema("service string, page long, body string").parquet(path)


add_cte("export_paged", ("events",), f"""
SELECT *, max(page) OVER (PARTITION BY service) AS last_page FROM (
  SELECT *, (row_number() OVER (PARTITION BY service ORDER BY event_id) - 1) // {PAGE_LIMIT} + 1 AS page
  FROM (SELECT event_id, ts, user_id, event_type, value,
               CASE user_id % 5 WHEN 0 THEN '{ORDERS}' WHEN 1 THEN '{INVENTORY}' WHEN 2 THEN '{PAYMENTS}'
                                WHEN 3 THEN '{SHIPPING}' ELSE '{NOTIFICATIONS}' END AS service FROM events))""")
add_cte("export_landed", ("export_paged",), f"""
SELECT * FROM export_paged
WHERE NOT (service = '{SHIPPING}' AND page = last_page * 4 // 5 + 1 AND event_type = 'error')""")
add_cte("export_pages", ("export_paged", "export_landed"), f"""
SELECT service, page, coalesce(n, 0) AS n, page < last_page AS has_next,
       service = '{NOTIFICATIONS}' AND page = last_page // 2 + 1 AS corrupt
FROM (SELECT DISTINCT service, page, last_page FROM export_paged)
LEFT JOIN (SELECT service, page, count(*) AS n FROM export_landed GROUP BY service, page) USING (service, page)""")
add_cte("export_stops", ("export_pages",), f"""
SELECT service, arg_min(page, page) FILTER (WHERE corrupt OR NOT has_next OR n < {PAGE_LIMIT}) AS stop_page,
       coalesce(arg_min(NOT corrupt, page) FILTER (WHERE corrupt OR NOT has_next OR n < {PAGE_LIMIT}), true) AS stop_ok
FROM export_pages GROUP BY service""")


@register("unpage_export", with_ctes("""
SELECT l.service, l.page, l.event_id, l.ts, l.user_id, l.event_type, l.value
FROM export_landed l JOIN export_stops s USING (service)
WHERE s.stop_ok AND (s.stop_page IS NULL OR l.page <= s.stop_page)""", "export_landed", "export_stops"))
def q_unpage_export(spark, sf_dir):
    return unpage_export(_landed_pages(spark, sf_dir), PAGE_LIMIT)


@register("collection_summary", with_ctes("""
SELECT service, CAST(sum(event_count) AS BIGINT) AS event_count, CAST(sum(pages_fetched) AS BIGINT) AS pages_fetched,
       CAST(sum(collected) AS BIGINT) AS services_collected, CAST(sum(failed) AS BIGINT) AS services_failed
FROM (SELECT p.service,
             CASE WHEN s.stop_ok THEN sum(p.n) ELSE 0 END AS event_count,
             CASE WHEN s.stop_ok THEN max(p.page) END AS pages_fetched,
             CAST(s.stop_ok AS BIGINT) AS collected, CAST(NOT s.stop_ok AS BIGINT) AS failed
      FROM export_pages p JOIN export_stops s USING (service)
      WHERE s.stop_page IS NULL OR p.page <= s.stop_page
      GROUP BY p.service, s.stop_ok)
GROUP BY ROLLUP (service)""", "export_pages", "export_stops"))
def q_collection_summary(spark, sf_dir):
    return collection_summary(_landed_pages(spark, sf_dir), PAGE_LIMIT)


# ---------------------------------------------------------------- K3: priority scope

@register("priority_scope", with_ctes(
    f"SELECT * FROM unified WHERE _service IN ('{ORDERS}', '{INVENTORY}', '{PAYMENTS}')", "unified"))
def q_priority_scope(spark, sf_dir):
    return scope.priority_scope(_in(spark, sf_dir).unified(), scope.service_table(spark))


# ---------------------------------------------------------------- K4 / K5: health

def _readings(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return ops.health_body(spark_ops_table(spark, "fx_readings", events=events))


def _checked(spark, sf_dir):
    return ops.health_ready(_readings(spark, sf_dir), "healthy", ("db", "cache"))


add_cte("health_checked", ("fx_readings",), """
SELECT service, event_id, reading_ts, http_status, priority,
       coalesce(http_status = 200 AND status = 'healthy' AND db_status = 'healthy' AND cache_status = 'healthy',
                false) AS ready
FROM fx_readings""")


@register("health_ready", with_ctes(
    "SELECT service, event_id, reading_ts, http_status, ready FROM health_checked", "health_checked"))
def q_health_ready(spark, sf_dir):
    return _checked(spark, sf_dir).select("service", "event_id", "reading_ts", "http_status", "ready")


@register("health_rollup", with_ctes("""
SELECT count(*) AS n_services, count(*) FILTER (WHERE ready) AS n_healthy,
       coalesce(bool_or(priority = 'critical' AND NOT ready), false) AS critical_down,
       round(coalesce(count(*) FILTER (WHERE ready) / nullif(count(*), 0), 0.0), 6) AS health_rate,
       CASE WHEN coalesce(bool_or(priority = 'critical' AND NOT ready), false)
              OR coalesce(count(*) FILTER (WHERE ready) / nullif(count(*), 0), 0.0) < 0.5
            THEN 'abort' ELSE 'full_pipeline' END AS route
FROM (SELECT *, row_number() OVER (PARTITION BY service ORDER BY reading_ts DESC, event_id DESC) AS _rn
      FROM health_checked) WHERE _rn = 1""", "health_checked"))
def q_health_rollup(spark, sf_dir):
    r = ops.health_rollup(_checked(spark, sf_dir))
    return r.withColumn("health_rate", rate(F.col("health_rate")))


# ---------------------------------------------------------------- K6 / K7 / K8

@register("log_triage", with_ctes(r"""
SELECT e.app, i.app_id, e.line_no, e.text
FROM (SELECT *, row_number() OVER (PARTITION BY app ORDER BY line_no DESC) AS _rn FROM fx_logs
      WHERE text LIKE '%Exception%' OR text LIKE '%Error%' OR text LIKE '%FAILED%' OR text LIKE '%killed%') e
LEFT JOIN (SELECT app, arg_min(id, line_no) AS app_id
           FROM (SELECT app, line_no, regexp_extract(text, '(application_[0-9]+_[0-9]+|app-[0-9]+-[0-9]+)', 1) AS id
                 FROM fx_logs) WHERE id <> '' GROUP BY app) i USING (app)
WHERE e._rn <= 30""", "fx_logs"))
def q_log_triage(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return ops.log_triage(spark_ops_table(spark, "fx_logs", events=events), tail=30)


@register("stage_metrics", with_ctes("""
SELECT s.*, coalesce(e.active_executors, 0) AS active_executors
FROM (SELECT app_id, count(*) AS total_stages, count(*) FILTER (WHERE status = 'COMPLETE') AS completed_stages,
             count(*) FILTER (WHERE status = 'FAILED') AS failed_stages, CAST(sum(num_tasks) AS BIGINT) AS total_tasks,
             CAST(sum(input_bytes) AS BIGINT) AS input_bytes, CAST(sum(output_bytes) AS BIGINT) AS output_bytes,
             CAST(sum(shuffle_read_bytes) AS BIGINT) AS shuffle_read_bytes
      FROM fx_stages GROUP BY app_id) s
LEFT JOIN (SELECT app_id, count(*) FILTER (WHERE is_active) AS active_executors FROM fx_executors GROUP BY app_id) e
  USING (app_id)""", "fx_stages", "fx_executors"))
def q_stage_metrics(spark, sf_dir):
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return ops.stage_metrics(spark_ops_table(spark, "fx_stages", lineitem=lineitem),
                             spark_ops_table(spark, "fx_executors", lineitem=lineitem))


@register("run_status", with_ctes("""
SELECT run_id, count(*) AS n_tasks, count(*) FILTER (WHERE state = 'failed') AS failed_tasks,
       bool_and(state IN ('success', 'skipped')) AS recovery_success,
       CASE WHEN count(*) FILTER (WHERE state = 'failed') > 0 THEN 'PARTIAL_FAILURE' ELSE 'SUCCESS' END
         AS pipeline_status
FROM fx_tasks GROUP BY run_id""", "fx_tasks"))
def q_run_status(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return ops.run_status(spark_ops_table(spark, "fx_tasks", events=events))


# ---------------------------------------------------------------- K9 / K10: recovery

RECOVERY_AS_OF = "2024-01-16 00:00:00"


@register("recovery_slice", with_ctes(f"""
SELECT * FROM unified WHERE _service IN ('{PAYMENTS}', '{SHIPPING}')
  AND "timestamp" > TIMESTAMP '{RECOVERY_AS_OF}' - INTERVAL '6' HOUR AND "timestamp" <= TIMESTAMP '{RECOVERY_AS_OF}'""",
    "unified"))
def q_recovery_slice(spark, sf_dir):
    return recovery.recovery_slice(_in(spark, sf_dir).unified(), (PAYMENTS, SHIPPING), 6, RECOVERY_AS_OF,
                                   strict=True)


def _per_key_sql(table: str, cols=("order_id", "amount", "status")) -> str:
    agree = " AND ".join(f"(count({c}) = 0 OR (count({c}) = count(*) AND min({c}) = max({c})))" for c in cols)
    mins = ", ".join(f"min({c}) AS {c}" for c in cols)
    return (f"SELECT event_id, count(*) AS n, {mins}, {agree} AS agree FROM {table} GROUP BY event_id")


@register("recovery_validate", with_ctes(f"""
SELECT CAST(coalesce(sum(o_n), 0) AS BIGINT) AS original_rows, CAST(coalesce(sum(r_n), 0) AS BIGINT) AS recovered_rows,
       count(*) FILTER (WHERE o_n IS NOT NULL AND r_n IS NOT NULL AND same) AS matched,
       count(*) FILTER (WHERE o_n IS NOT NULL AND r_n IS NOT NULL AND NOT same) AS changed,
       CAST(coalesce(sum(o_n) FILTER (WHERE r_n IS NULL), 0) AS BIGINT) AS missing,
       CAST(coalesce(sum(r_n) FILTER (WHERE o_n IS NULL), 0) AS BIGINT) AS extra,
       count(*) FILTER (WHERE r_n IS NULL OR o_n IS NULL OR NOT same) = 0 AS passed
FROM (SELECT o.n AS o_n, r.n AS r_n,
             o.n = r.n AND o.agree AND r.agree AND o.order_id IS NOT DISTINCT FROM r.order_id
             AND o.amount IS NOT DISTINCT FROM r.amount AND o.status IS NOT DISTINCT FROM r.status AS same
      FROM ({_per_key_sql("valid_payments")}) o FULL OUTER JOIN ({_per_key_sql("fx_recovered")}) r
        ON o.event_id = r.event_id)""",
    "valid_payments", "fx_recovered"))
def q_recovery_validate(spark, sf_dir):
    i = _in(spark, sf_dir)
    original = i.valid(PAYMENTS)
    recovered = spark_ops_table(spark, "fx_recovered", valid_payments=original, fx_base=i.fx.table("fx_base"))
    return recovery.recovery_validate(original, recovered, "event_id", ("order_id", "amount", "status"))


# ---------------------------------------------------------------- K11: publish

def _targets():
    return {ORDERS: None, PAYMENTS: None, INVENTORY: None, SHIPPING: None,
            NOTIFICATIONS: F.col("currency") == "JPY"}


@register("publish_payloads", with_ctes(f"""
SELECT target, CAST(n AS BIGINT) AS rows_written, CASE WHEN n > 0 THEN 'published' ELSE 'failed' END AS status
FROM (SELECT '{ORDERS}' AS target, (SELECT count(*) FROM order_metrics) AS n
      UNION ALL SELECT '{PAYMENTS}', (SELECT count(*) FROM order_metrics)
      UNION ALL SELECT '{INVENTORY}', (SELECT count(*) FROM order_metrics)
      UNION ALL SELECT '{SHIPPING}', (SELECT count(*) FROM order_metrics)
      UNION ALL SELECT '{NOTIFICATIONS}', (SELECT count(*) FROM order_metrics WHERE currency = 'JPY'))""",
    "order_metrics"))
def q_publish_payloads(spark, sf_dir):
    results = _order_metrics(_in(spark, sf_dir))
    return publish_payloads(spark, results, _targets(), RUN_ID, scratch_path(spark, "publish"))
