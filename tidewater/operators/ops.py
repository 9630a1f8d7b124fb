"""Operations roll-ups re-aimed as DataFrame work (K2-K8).

Health readings, driver logs, Spark stage records and task states arrive as
tables; each roll-up is a grouped aggregate (partial-aggregated before its
shuffle), so a service, app or run holding a third of the rows costs one row
per map task on the wire.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, MapType, StringType, StructField, StructType

from tidewater.operators.timeline import latest_by

# ---------------------------------------------------------------- K4 / K5: health

HEALTH_SCHEMA = StructType([
    StructField("status", StringType()), StructField("service", StringType()),
    StructField("version", StringType()), StructField("uptime", LongType()),
    StructField("dependencies", MapType(StringType(), StructType([StructField("status", StringType())]))),
])


def health_body(readings: DataFrame) -> DataFrame:
    """Render the JSON body a health endpoint returns (for derived readings)."""
    deps = F.map_filter(
        F.create_map(F.lit("db"), F.struct(F.col("db_status").alias("status")),
                     F.lit("cache"), F.struct(F.col("cache_status").alias("status"))),
        lambda k, v: v["status"].isNotNull())
    body = F.to_json(F.struct(F.col("status"), F.col("service"), F.lit("1.0.0").alias("version"),
                              F.col("event_id").alias("uptime"), deps.alias("dependencies")))
    return readings.select("event_id", "reading_ts", "service", "http_status", "priority", body.alias("body"))


def health_ready(readings: DataFrame, expected_status: str = "healthy",
                 required_dependencies: tuple[str, ...] = ()) -> DataFrame:
    """A reading passes iff HTTP 200, the body's status equals the expected
    one, and every required dependency reports ``healthy`` (a missing one
    does not).  Unparsable bodies fail."""
    doc = F.from_json(F.col("body"), HEALTH_SCHEMA)
    deps_ok = F.lit(True)
    if required_dependencies:
        deps_ok = F.forall(F.array(*[F.lit(d) for d in required_dependencies]),
                           lambda d: F.coalesce(doc["dependencies"][d]["status"] == F.lit("healthy"), F.lit(False)))
    ready = ((F.col("http_status") == 200)
             & F.coalesce(doc["status"] == F.lit(expected_status), F.lit(False))
             & deps_ok)
    return readings.withColumn("ready", F.coalesce(ready, F.lit(False)))


# fixed values: below this share of ready services the run is aborted
MIN_HEALTH_RATE = 0.5


def health_rollup(checked: DataFrame, min_rate: float = MIN_HEALTH_RATE) -> DataFrame:
    """Latest reading per service -> one routing row.

    ``route`` is ``abort`` when a critical service is not ready or fewer than
    ``min_rate`` of the services are, else ``full_pipeline``.
    """
    latest = latest_by(checked, "service", {"ready": "ready", "priority": "priority"},
                       order_cols=("reading_ts", "event_id"))
    out = latest.agg(F.count(F.lit(1)).alias("n_services"),
                     F.count_if(F.col("ready")).alias("n_healthy"),
                     F.coalesce(F.bool_or((F.col("priority") == "critical") & ~F.col("ready")),
                                F.lit(False)).alias("critical_down"))
    out = out.withColumn("health_rate", F.coalesce(F.try_divide(F.col("n_healthy"), F.col("n_services")),
                                                   F.lit(0.0)))
    return out.withColumn("route", F.when(F.col("critical_down") | (F.col("health_rate") < min_rate), "abort")
                          .otherwise("full_pipeline"))


# ---------------------------------------------------------------- K6: driver logs

# fixed values: application id forms (YARN and standalone), error keywords, error lines kept per app
APP_ID_PATTERN = r"(application_[0-9]+_[0-9]+|app-[0-9]+-[0-9]+)"
ERROR_KEYWORDS = ("Exception", "Error", "FAILED", "killed")
ERROR_TAIL_LINES = 30


def log_triage(lines: DataFrame, tail: int = ERROR_TAIL_LINES) -> DataFrame:
    """Per app: the first application id seen, and the last ``tail`` lines
    holding an error keyword (top-k per app; Spark limits each map partition
    to its own top-k before the shuffle)."""
    from pyspark.sql import Window
    app_id = F.regexp_extract("text", APP_ID_PATTERN, 1)
    ids = (lines.withColumn("_id", app_id).filter(F.col("_id") != "")
           .groupBy("app").agg(F.min_by("_id", "line_no").alias("app_id")))
    hit = None
    for kw in ERROR_KEYWORDS:
        c = F.col("text").contains(kw)
        hit = c if hit is None else hit | c
    errors = (lines.filter(hit)
              .withColumn("_rn", F.row_number().over(Window.partitionBy("app").orderBy(F.col("line_no").desc())))
              .filter(F.col("_rn") <= tail).drop("_rn"))
    return errors.join(ids, "app", "left").select("app", "app_id", "line_no", "text")


# ---------------------------------------------------------------- K7: stage metrics

def stage_metrics(stages: DataFrame, executors: DataFrame | None = None) -> DataFrame:
    """Per application: stage counts by status and summed task / byte counters;
    with executor records (app_id, is_active), also how many are active."""
    out = _stage_counts(stages)
    if executors is None:
        return out
    active = executors.groupBy("app_id").agg(F.count_if(F.col("is_active")).alias("active_executors"))
    return out.join(active, "app_id", "left").withColumn("active_executors", F.coalesce("active_executors", F.lit(0).cast("long")))


def _stage_counts(stages: DataFrame) -> DataFrame:
    # fixed values: stage states and output names
    return (stages.groupBy("app_id")
            .agg(F.count(F.lit(1)).alias("total_stages"),
                 F.count_if(F.col("status") == "COMPLETE").alias("completed_stages"),
                 F.count_if(F.col("status") == "FAILED").alias("failed_stages"),
                 F.sum("num_tasks").alias("total_tasks"),
                 F.sum("input_bytes").alias("input_bytes"),
                 F.sum("output_bytes").alias("output_bytes"),
                 F.sum("shuffle_read_bytes").alias("shuffle_read_bytes")))


# fixed values: field names of the monitoring API
STAGE_RECORD_SCHEMA = StructType([
    StructField("app_id", StringType()), StructField("status", StringType()),
    StructField("numTasks", LongType()), StructField("inputBytes", LongType()),
    StructField("outputBytes", LongType()), StructField("shuffleReadBytes", LongType()),
])


def read_stage_records(spark, path: str) -> DataFrame:
    """Stage records saved as JSON Lines (fields as the monitoring API names them)."""
    df = spark.read.schema(STAGE_RECORD_SCHEMA).json(path)
    return df.select("app_id", "status", F.col("numTasks").alias("num_tasks"),
                     F.col("inputBytes").alias("input_bytes"), F.col("outputBytes").alias("output_bytes"),
                     F.col("shuffleReadBytes").alias("shuffle_read_bytes"))


# ---------------------------------------------------------------- K8: run status

# fixed values: task states a recovery run may end in and still count as a success
RECOVERY_OK_STATES = ("success", "skipped")


def run_status(tasks: DataFrame) -> DataFrame:
    """Per run: failed task count, SUCCESS / PARTIAL_FAILURE, and whether every
    task ended in success or skipped."""
    return (tasks.groupBy("run_id")
            .agg(F.count(F.lit(1)).alias("n_tasks"),
                 F.count_if(F.col("state") == "failed").alias("failed_tasks"),
                 F.bool_and(F.coalesce(F.col("state").isin(*RECOVERY_OK_STATES), F.lit(False)))
                 .alias("recovery_success"))
            .withColumn("pipeline_status",
                        F.when(F.col("failed_tasks") > 0, "PARTIAL_FAILURE").otherwise("SUCCESS")))
