"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import release, stored


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node with an edge to another; component: the smallest node reachable.

    Each round joins every node with the least of its neighbours, so a hub's
    neighbours are never gathered; rounds grow with the logarithm of the
    longest path.  Nulls and self-loops are dropped; no edges give no rows.
    """
    e = (edges.where(F.col(a) != F.col(b))
         .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    e = stored(e, "edges")
    mark = _mark(e)
    while mark[0]:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = stored(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        release(e)
        e, before, mark = after, mark, _mark(after)
        if mark == before:
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        e.select("v", F.col("v").alias("component")).distinct())
