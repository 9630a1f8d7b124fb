"""Small helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import delete_folders, scratch_path

#: Bytes of text that a Python worker handles at a time.
STEP_BYTES = 2 << 20

#: The white space that separates words, [\x20\x09-\x0D].
WHITE_SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back.

    Cuts the lineage: a lost executor rebuilds nothing above this point.  What
    the step shuffled is not needed any more; Spark deletes those files when the
    driver's garbage is collected, which is asked for here, so that the steps
    of an operator don't add up on the executors' disks.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    spark.sparkContext._jvm.System.gc()
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def release(*steps: DataFrame) -> None:
    """Delete what ``stored`` wrote, once all that reads it is written too."""
    for step in steps:
        delete_folders(step.sparkSession, [step.stored_at])


def handing_back(run: Callable) -> Callable:
    """``run`` for mapInArrow; when a task ends, its memory goes back to the system.

    Python workers outlive their tasks, and several stages' workers share an executor.
    """
    def wrapped(batches):
        import ctypes
        import gc

        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return wrapped


def spans_of_rows(batch: pa.RecordBatch, column: str, most: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` whose ``column`` holds about ``most`` bytes (one row at least)."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(size)
    if batch.num_rows > start:
        yield batch.slice(start)


def map_texts(df: DataFrame, fn: Callable[[list, Iterable[str]], pa.RecordBatch], schema: str,
              key: str = "doc_id", text: str = "text") -> DataFrame:
    """``fn(keys, texts)`` over bounded slices of the rows; a null text is an empty one.

    Only the two columns are read; ``fn`` returns one Arrow batch.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in spans_of_rows(batch, "text"):
                yield fn(part.column(0).to_pylist(), [x or "" for x in part.column(1).to_pylist()])

    return df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(handing_back(run), schema)


def arrow(schema: str, **columns) -> pa.RecordBatch:
    """An Arrow batch with the columns of a DDL schema such as ``"a long, b string"``."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64(),
             "boolean": pa.bool_(), "binary": pa.binary(), "array<double>": pa.list_(pa.float64()),
             "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}
    names = [x.strip().split(" ", 1) for x in schema.split(",")]
    return pa.RecordBatch.from_arrays([pa.array(columns[n], kinds[k.strip()]) for n, k in names], [n for n, _ in names])
