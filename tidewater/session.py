"""Session helpers: a tuned local/test session and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "tidewater", extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench. On a cluster, pass nothing and let
    spark-submit decide master, memory and shuffle partitions; we only pin what
    correctness needs.  Tests and the bench name their master and partitions."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        # service times are UTC wall clock; NTZ arithmetic below is zone-free
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # PySpark otherwise records the Python call site of every Column /
        # DataFrame call (several JVM round trips each) for error messages;
        # plans here are built from hundreds of calls
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master:  # one JVM for tests and the bench
        conf["spark.driver.memory"] = os.environ.get("TIDEWATER_DRIVER_MEMORY", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    Read it from the session; only when it is unset (local tests) create one
    and register it, so ``DataFrame.checkpoint()`` and our scratch writes land
    on storage every executor can reach.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            # a machine-local folder is invisible to the other executors
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="tidewater-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never-reused sub-folder of the shared folder."""
    return f"{shared_dir(spark)}/tidewater-scratch/{label}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is there, on whatever store it lies."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def delete_folders(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def partition_folder(spark: SparkSession, column: str, value: str) -> str:
    """The folder that a partitioned write gives to ``value``."""
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return f"{column}={names.escapePathName(value)}"
