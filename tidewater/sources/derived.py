"""Inputs of the operations roll-ups, derived from the ``events`` and
``lineitem`` test tables.  As with the service fixtures, one SQL text serves
Spark (``{table}`` slots bound to DataFrames) and DuckDB (CTE names); the only
engine-specific token is ``PROPS_K`` (the integer ``k`` inside ``props``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

OPS_SQL: dict[str, str] = {
    # one health reading per event: service, HTTP code, reported status, two dependencies
    "fx_readings": """
SELECT event_id, ts AS reading_ts, 'svc-' || CAST(user_id % 12 AS STRING) AS service,
       CASE WHEN event_type = 'error' AND value > 150 THEN 503
            WHEN event_type = 'error' AND value > 100 THEN 500 ELSE 200 END AS http_status,
       CASE WHEN event_type = 'error' THEN 'degraded'
            WHEN event_type = 'signup' AND value > 100 THEN 'starting' ELSE 'healthy' END AS status,
       CASE WHEN PROPS_K % 5 = 0 THEN 'down' ELSE 'healthy' END AS db_status,
       CASE WHEN PROPS_K % 3 = 0 THEN NULL WHEN PROPS_K % 7 = 0 THEN 'degraded' ELSE 'healthy' END AS cache_status,
       CASE (user_id % 12) % 4 WHEN 0 THEN 'critical' WHEN 3 THEN 'medium' ELSE 'high' END AS priority
FROM {events}
""",
    # driver-log lines with both application id forms and the four error keywords
    "fx_logs": """
SELECT 'spark-job-' || CAST(user_id % 7 AS STRING) AS app, event_id AS line_no,
       event_type || ' ' || CAST(event_id AS STRING) || ' ' || CASE event_type
         WHEN 'signup' THEN 'submitted application_' || CAST(1700000000 + user_id AS STRING) || '_' || CAST(event_id AS STRING)
         WHEN 'view' THEN 'registered app-20240101000000-' || CAST(user_id AS STRING)
         WHEN 'error' THEN 'java.lang.IllegalStateException: task failed'
         WHEN 'purchase' THEN CASE WHEN value > 100 THEN 'stage FAILED' ELSE 'stage done' END
         ELSE CASE WHEN value > 200 THEN 'container killed by driver' ELSE 'heartbeat Error-free' END
       END AS text
FROM {events}
""",
    # stage records of Spark applications
    "fx_stages": """
SELECT 'app-' || CAST(l_suppkey AS STRING) AS app_id,
       CASE WHEN l_returnflag = 'R' THEN 'FAILED' WHEN l_linestatus = 'F' THEN 'COMPLETE' ELSE 'ACTIVE' END AS status,
       CAST(l_linenumber AS BIGINT) AS num_tasks, CAST(floor(l_quantity * 1024) AS BIGINT) AS input_bytes,
       CAST(floor(l_extendedprice) AS BIGINT) AS output_bytes,
       CAST(floor(l_extendedprice * l_discount) AS BIGINT) AS shuffle_read_bytes
FROM {lineitem}
""",
    # executor records of the same applications, the driver's own among them
    "fx_executors": """
SELECT 'app-' || CAST(l_suppkey AS STRING) AS app_id, CAST(l_linenumber AS STRING) AS executor_id,
       l_returnflag <> 'N' OR l_linenumber = 1 AS is_active
FROM {lineitem}
""",
    # task instances of pipeline runs
    "fx_tasks": """
SELECT 'run_' || CAST(user_id AS STRING) AS run_id, 'task_' || CAST(event_id AS STRING) AS task_id,
       CASE WHEN event_type = 'error' AND value > 150 THEN 'failed'
            WHEN event_type = 'signup' AND value > 200 THEN 'upstream_failed'
            WHEN event_type = 'view' THEN 'skipped' ELSE 'success' END AS state
FROM {events}
""",
    # a re-run of the payments: some rows missing, some changed, some extra
    "fx_recovered": """
SELECT event_id, order_id,
       CASE WHEN CAST(substr(order_id, 5) AS BIGINT) % 17 = 0 THEN amount + 1.0 ELSE amount END AS amount, status
FROM {valid_payments} WHERE CAST(substr(order_id, 5) AS BIGINT) % 13 <> 0
UNION ALL
SELECT 'pay_evt_' || CAST(k AS STRING) || '_9' AS event_id, 'ord_' || CAST(k AS STRING) AS order_id,
       amt AS amount, 'approved' AS status
FROM {fx_base} WHERE k % 10 = 9 AND k % 7 = 3
""",
}

OPS_DEPS = {"fx_readings": ("events",), "fx_logs": ("events",), "fx_stages": ("lineitem",), "fx_executors": ("lineitem",),
            "fx_tasks": ("events",), "fx_recovered": ("valid_payments", "fx_base")}

_SPARK_PROPS_K = "CAST(get_json_object(props, '$.k') AS BIGINT)"
_DUCK_PROPS_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"


def spark_ops_table(spark: SparkSession, name: str, **tables: DataFrame) -> DataFrame:
    text = OPS_SQL[name].replace("PROPS_K", _SPARK_PROPS_K)
    return spark.sql(text, **tables)


def duck_ops_text(name: str) -> str:
    text = OPS_SQL[name].replace("PROPS_K", _DUCK_PROPS_K)
    return text.format(**{d: d for d in OPS_DEPS[name]})
