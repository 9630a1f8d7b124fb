"""Schema-enforced scans of service event files (A1-A3, L1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from tidewater.schemas import CORRUPT_COL, schema_for


def normalise_timestamps(df: DataFrame) -> DataFrame:
    """Turn every session-zone timestamp column into ``timestamp_ntz``.

    The cast keeps the wall clock of the session zone, which our sessions pin
    to UTC, so ``...Z`` strings and offset-free strings land on the same value.
    """
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, TimestampType):
            cols.append(F.col(f.name).cast(TimestampNTZType()).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


#: Tables up to so many bytes (as Spark estimates a scan) are small: two row groups of the usual size.
SMALL_TABLE = 256 << 20


def deal_out_small(df: DataFrame, key: str, most: int = SMALL_TABLE) -> DataFrame:
    """``df``, by hash of ``key`` over the session's cores if it is small; else as it is.

    A Parquet file splits at row groups, and a small one has a single one: its whole scan, and
    what follows up to the first shuffle, would be one task.  The shuffle of at most ``most`` bytes costs less than
    that.  A large table has many row groups and is never shuffled here.
    """
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    if int(str(size)) > most:
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, key)


def read_service_events(spark: SparkSession, path: str, service: str,
                        fmt: str = "json", keep_corrupt: bool = True) -> DataFrame:
    """Read one service's raw events with its fixed schema.

    ``fmt`` is ``json`` (JSON Lines, one event per line), ``csv`` (header row)
    or ``parquet``.  Malformed JSON/CSV lines are kept, with their raw text in
    ``_corrupt_record``, so validation can quarantine them one by one.
    """
    if fmt == "json":
        df = (spark.read.schema(schema_for(service, with_corrupt=True))
              .option("multiLine", False)
              .option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT_COL)
              .json(path))
    elif fmt == "csv":
        df = (spark.read.schema(schema_for(service, with_corrupt=True))
              .option("header", True)
              .option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT_COL)
              .csv(path))
    elif fmt == "parquet":
        raw = spark.read.parquet(path)
        present = set(raw.columns)
        df = raw.select(*[F.col(c) if c in present else F.lit(None).cast(t).alias(c)
                          for c, t in ((f.name, f.dataType) for f in schema_for(service).fields)])
        df = df.withColumn(CORRUPT_COL, F.lit(None).cast("string"))
    else:
        raise ValueError(f"unsupported format {fmt!r}")
    df = normalise_timestamps(df)
    return df if keep_corrupt else df.drop(CORRUPT_COL)


def read_service_partition(spark: SparkSession, path: str, service: str,
                           partition_col: str = "_service") -> DataFrame:
    """Parquet scan of one service out of a table partitioned by service;
    the equality filter prunes every other partition directory."""
    return spark.read.parquet(path).filter(F.col(partition_col) == F.lit(service))


def read_tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir.rstrip('/')}/{n}.parquet") for n in names}
