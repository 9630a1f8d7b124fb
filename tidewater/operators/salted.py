"""Skew-aware salted join (L2).

Each key gets as many salts as its left rows need at ``rows_per_salt`` each.
Left rows are dealt over their key's salts by a hash of ``salt_col``; right
rows are copied once per salt of their key.  Joining on (key, salt) spreads
every hot key over tasks and returns exactly the plain join.

Which keys are hot is found by an exact count of all keys (``key_salts``), or by a
frequency sketch in one pass without a shuffle of the keys (``sketched_salts``), after which the hot ones alone are counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_salts(df: DataFrame, key: str, rows_per_salt: int) -> DataFrame:
    """(key, salts) of every key that needs more than one salt; counts are
    pre-aggregated before the shuffle."""
    return (df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
            .filter(F.col("_n") > F.lit(rows_per_salt))
            .select(key, F.ceil(F.col("_n") / F.lit(rows_per_salt)).cast("long").alias("_salts")))


#: Keys that the frequency sketch tracks and the hottest that are taken from it.
TRACKED, HOTTEST = 100_000, 10_000


def sketched_salts(df: DataFrame, key: str, rows_per_salt: int, tracked: int = TRACKED, hottest: int = HOTTEST) -> DataFrame:
    """(key, salts) like ``key_salts``, of the keys that a mergeable frequency sketch calls hot.

    The sketch is off by at most 3.5 / ``tracked`` of all rows, so a key with a larger share than that over
    ``rows_per_salt`` is not missed; a missed key is joined unsalted, which changes no row.  Candidates are ``hottest``
    at most; only their rows are counted, collapsed in the map tasks.
    """
    named = df.filter(F.col(key).isNotNull())
    found = named.agg(F.expr(f"approx_top_k(`{key}`, {hottest}, {tracked})").alias("_top"))
    hot = (found.select(F.explode("_top").alias("_t")).where(F.col("_t.count") > rows_per_salt * 0.5)
           .select(F.col("_t.item").alias("_hot")))
    return key_salts(named.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left_semi"), key, rows_per_salt)


def salted_join(left: DataFrame, right: DataFrame, key: str, salt_col: str,
                how: str = "left", rows_per_salt: int = 1 << 20, sketch: bool = False) -> DataFrame:
    if how not in ("left", "inner"):
        raise ValueError("salted_join supports left and inner joins")
    salts = (sketched_salts if sketch else key_salts)(left, key, rows_per_salt)
    own = F.coalesce("_salts", F.lit(1).cast("long"))
    dealt = (left.join(salts, key, "left")
             .withColumn("_salt", F.pmod(F.coalesce(F.xxhash64(salt_col), F.lit(0)), own)).drop("_salts"))
    copied = (right.join(salts, key, "left")
              .withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), own - 1))).drop("_salts"))
    return dealt.join(copied, [key, "_salt"], how).drop("_salt")
