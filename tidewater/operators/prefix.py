"""Running sums per key that split a hot key over many tasks.

``sum(m) OVER (PARTITION BY keys ORDER BY order ROWS UNBOUNDED PRECEDING)``
puts each key in one task.  Here a key's rows are cut into slices by the order
value itself - an hour of a timestamp, a fixed stretch of a number - so which
slice a row is in follows from the row alone, in every branch and every rerun.
One window pass per (key, slice) gives the in-slice running sum; the slice
totals of a key (one row per slice) give the offset added back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType


def null_safe_join(left: DataFrame, right: DataFrame, cols: list[str], how: str) -> DataFrame:
    """Equi-join on ``cols`` where NULL matches NULL; keeps ``left``'s key columns."""
    r = right.select(*[F.col(c).alias(f"_r_{c}") for c in cols],
                     *[c for c in right.columns if c not in cols])
    cond = None
    for c in cols:
        e = left[c].eqNullSafe(r[f"_r_{c}"])
        cond = e if cond is None else cond & e
    return left.join(r, cond, how).drop(*[f"_r_{c}" for c in cols])


# parts of a slice unit: how many of it make one of the next larger unit
_UNITS = {"day": 1, "hour": 24, "minute": 60, "second": 60}


def slice_of(df: DataFrame, col: str, width: int | str | None) -> Column:
    """The slice of each value of ``col``, rising with it: the day, hour (default),
    minute or second of a time, a stretch of ``width`` values (default 65,536) of a number."""
    kind, c = df.schema[col].dataType, F.col(col)
    if isinstance(kind, NumericType):
        return F.floor(c / F.lit(width or 1 << 16))
    if isinstance(kind, TimestampType):  # an instant: counted in UTC
        seconds = {"day": 86400, "hour": 3600, "minute": 60, "second": 1}[width or "hour"]
        return F.floor(F.unix_seconds(c) / seconds)
    if isinstance(kind, (DateType, TimestampNTZType)):  # a wall clock: no zone comes in
        out = F.unix_date(c.cast("date")).cast("long")
        for unit, part in (("hour", F.hour), ("minute", F.minute), ("second", F.second)):
            if (width or "hour") in list(_UNITS)[list(_UNITS).index(unit):]:
                out = out * _UNITS[unit] + (part(c) if isinstance(kind, TimestampNTZType) else F.lit(0))
        return out
    raise TypeError(f"{col}: a running sum is sliced by a time or a number, not {kind.simpleString()}")


def sliced_running_sums(df: DataFrame, keys: list[str], order: list[str], measures: dict[str, Column],
                        width: int | str | None = None) -> DataFrame:
    """``df`` plus one running-sum column per measure (ROWS frame, NULLs count
    as 0, NULL order values first).  ``(keys, order)`` should be unique per row,
    otherwise rows tied on it are summed in no particular order.  ``width`` is
    the extent of a slice of the first order column (:func:`slice_of`); the
    result does not depend on it."""
    sliced = df.withColumn("_slice", slice_of(df, order[0], width))
    upto = (Window.partitionBy(*keys, "_slice").orderBy(*order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    in_slice = sliced.select("*", *[F.sum(m).over(upto).alias(f"_in_{n}") for n, m in measures.items()])
    # pre-aggregated before the shuffle: one row per key and slice
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (sliced.groupBy(*keys, "_slice").agg(*[F.sum(m).alias(f"_tot_{n}") for n, m in measures.items()])
               .select(*keys, "_slice", *[F.sum(f"_tot_{n}").over(before).alias(f"_off_{n}") for n in measures]))
    joined = null_safe_join(in_slice, offsets, [*keys, "_slice"], "left")
    return joined.select(*df.columns, *[
        (F.coalesce(F.col(f"_off_{n}"), F.lit(0)) + F.coalesce(F.col(f"_in_{n}"), F.lit(0))).alias(n)
        for n in measures])
