"""Recovery slice and recovery validation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.rules import as_of_col
from tidewater.schemas import SERVICES
from tidewater.sinks.event_log import HOUR, hour_of


def recovery_slice(events: DataFrame, failed_services=("all",), window_hours: int = 2, as_of=None,
                   strict: bool = False, service_col: str = "_service", ts_col: str = "timestamp") -> DataFrame:
    """Events of the failed services in (as_of - window_hours, as_of].

    ``all`` selects every service.  With ``strict`` an unknown service name
    raises instead of being skipped (recovery mode tolerates no failure).
    On a table partitioned by service the ``isin`` prunes directories, and on
    a log laid out by hour (sinks/event_log.py) the hours of the window prune as well.
    """
    names = list(failed_services)
    if "all" in names:
        names = list(SERVICES)
    unknown = [n for n in names if n not in SERVICES]
    if unknown and strict:
        raise ValueError(f"unknown services in recovery request: {unknown}")
    names = [n for n in names if n in SERVICES]
    end = as_of_col(as_of)
    start = end - F.make_dt_interval(F.lit(0), F.lit(window_hours))
    kept = events.filter(F.col(service_col).isin(*names) & (F.col(ts_col) > start) & (F.col(ts_col) <= end))
    if HOUR in events.columns:
        kept = kept.filter(F.col(HOUR).between(hour_of(start), hour_of(end)))
    return kept


def _per_key(df: DataFrame, key: str, compare: tuple[str, ...], side: str) -> DataFrame:
    """One row per key: copies, and per compare column whether all copies
    agree (all NULL, or all set to one value) and that value."""
    aggs = [F.count(F.lit(1)).alias(f"_{side}_n")]
    for c in compare:
        aggs += [F.min(c).alias(f"_{side}_min_{c}"), F.max(c).alias(f"_{side}_max_{c}"),
                 F.count(c).alias(f"_{side}_cnt_{c}")]
    out = df.groupBy(key).agg(*aggs)
    agree = F.lit(True)
    for c in compare:
        cnt, n = F.col(f"_{side}_cnt_{c}"), F.col(f"_{side}_n")
        agree = agree & ((cnt == 0) | ((cnt == n) & (F.col(f"_{side}_min_{c}") == F.col(f"_{side}_max_{c}"))))
    return out.select(key, f"_{side}_n", *[f"_{side}_min_{c}" for c in compare], agree.alias(f"_{side}_agree"))


def recovery_validate(original: DataFrame, recovered: DataFrame, key: str = "event_id",
                      compare: tuple[str, ...] = ()) -> DataFrame:
    """Recovered vs original rows by ``key``.

    ``original_rows`` / ``recovered_rows`` count rows; ``missing`` / ``extra``
    count rows whose key is absent on the other side (a NULL key never
    matches); ``matched`` / ``changed`` count keys present on both sides -
    matched when both hold the same number of copies and every ``compare``
    column agrees across all copies on both sides (NULL-safe).  ``passed``
    when nothing is missing, extra or changed.

    Each side is first reduced to one row per key (a partial aggregate, so a
    key holding a third of the rows ships one row per map task), so the full
    outer join is one-to-one and never emits pairs of copies.
    """
    o = _per_key(original, key, compare, "o")
    r = _per_key(recovered, key, compare, "r")
    j = o.join(r, o[key] == r[key], "full_outer")
    same = (F.col("_o_n") == F.col("_r_n")) & F.col("_o_agree") & F.col("_r_agree")
    for c in compare:
        same = same & F.col(f"_o_min_{c}").eqNullSafe(F.col(f"_r_min_{c}"))
    both = F.col("_o_n").isNotNull() & F.col("_r_n").isNotNull()
    zero = F.lit(0).cast("long")
    out = j.agg(F.coalesce(F.sum("_o_n"), zero).alias("original_rows"),
                F.coalesce(F.sum("_r_n"), zero).alias("recovered_rows"),
                F.count_if(both & same).alias("matched"),
                F.count_if(both & ~same).alias("changed"),
                F.coalesce(F.sum(F.when(F.col("_r_n").isNull(), F.col("_o_n"))), zero).alias("missing"),
                F.coalesce(F.sum(F.when(F.col("_o_n").isNull(), F.col("_r_n"))), zero).alias("extra"))
    return out.withColumn("passed", (F.col("missing") == 0) & (F.col("extra") == 0) & (F.col("changed") == 0))
