"""N-way union of service tables into the common-column event log (C4, H1)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.schemas import COMMON_COLUMNS


def unify_services(frames: dict[str, DataFrame], extra: tuple[str, ...] = ()) -> DataFrame:
    """``UNION ALL`` by name of each service's common columns plus ``_service``.

    Every branch is projected first (also when only one service is given), so
    the output schema never depends on how many services were valid.
    Columns of ``extra`` are kept where present and NULL elsewhere.
    """
    if not frames:
        raise ValueError("no service frames to unify")
    parts = []
    for service, df in frames.items():
        cols = [c for c in COMMON_COLUMNS + tuple(extra) if c in df.columns]
        parts.append(df.select(*cols).withColumn("_service", F.lit(service)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
