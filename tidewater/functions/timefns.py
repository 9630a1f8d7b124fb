"""Zone-free time arithmetic on ``timestamp_ntz`` columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_seconds_between(start: Column, end: Column) -> Column:
    """end - start in whole seconds, each side cut to the second first
    (the semantics of subtracting two unix timestamps)."""
    return F.timestamp_diff("SECOND", F.date_trunc("second", start), F.date_trunc("second", end))


def hours_between(start: Column, end: Column) -> Column:
    return whole_seconds_between(start, end) / F.lit(3600.0)


def minutes(length: str) -> int:
    """'30 minutes' / '30m' / '1h' / '1 hour' -> minutes."""
    s = length.strip().lower().replace(" ", "")
    for suffix, mult in (("minutes", 1), ("minute", 1), ("mins", 1), ("min", 1), ("m", 1),
                         ("hours", 60), ("hour", 60), ("h", 60), ("days", 1440), ("day", 1440), ("d", 1440)):
        if s.endswith(suffix) and s[: -len(suffix)].isdigit():
            return int(s[: -len(suffix)]) * mult
    raise ValueError(f"cannot read window length {length!r}")
