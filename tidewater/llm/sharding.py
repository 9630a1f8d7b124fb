"""Sharding by histogram sort, with DataFrame functions only.

Rows are ordered by (hash of the text, doc_id), so equal texts lie together.
Splitters are found by counting exact bytes below candidate keys over all
partitions and refining the candidates around each splitter until it meets the
tolerance; then the rows are exchanged once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import stored

BITS, STEP = 64, 12
LOWEST = -(1 << 63)


@dataclass
class Splitter:
    """Rows with a key below (``hash``, ``doc``) come before the splitter."""

    hash: int
    doc: int | None = None


def keyed(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, the size, crc32 and hash of the text; texts go no further."""
    data = F.encode(F.coalesce(F.col(text), F.lit("")), "utf-8")
    return docs.select(F.col(key).cast("long").alias("doc_id"), (F.length(data) + F.lit(8)).cast("long").alias("size"),
                       F.crc32(data).alias("text_crc32"), F.xxhash64(data).alias("h"))


def _probe(rows: DataFrame, column: str, brackets: list[int], bits: int, step: int = STEP):
    """Exact bytes and rows between candidate keys.

    Each bracket [low, low + 2**bits) of ``column`` is cut in 2**STEP equal parts at most; the
    driver gets a row for each part that holds rows: at most 2**STEP for each splitter, whatever the input.
    Returns, by bracket, its parts as (low key, bytes, rows) in order, and the bits of a part.
    """
    shift = max(0, bits - step)
    rank = F.coalesce(F.col(column), F.lit(LOWEST)).bitwiseXOR(F.lit(LOWEST))  # unsigned order
    if bits < BITS:
        rows = rows.where(F.shiftrightunsigned(rank, bits).isin([(low - LOWEST) >> bits for low in brackets]))
    out: dict[int, list[tuple[int, int, int]]] = {low: [] for low in brackets}
    counted = rows.groupBy(F.shiftrightunsigned(rank, shift).alias("part")).agg(
        F.sum("size").alias("bytes"), F.count("*").alias("n"))
    for r in counted.collect():
        at = (r["part"] & ((1 << BITS) - 1)) << shift
        out[(at >> bits << bits) + LOWEST].append((at + LOWEST, r["bytes"], r["n"]))
    return {low: sorted(parts) for low, parts in out.items()}, shift


def _refine(parts: list[tuple[int, int, int]], width: int, below: int, goal: float, near: float):
    """Where the goal falls among ``parts``: (cut, None) if a boundary meets the tolerance or one row
    holds the goal, else (None, the part to refine and the bytes below it)."""
    for at, held, n in parts:
        if goal - below <= near:
            return at, None
        if below + held >= goal:
            if below + held - goal <= near or (n == 1 and below + held - goal < goal - below):
                return at + width, None
            return (at, None) if n == 1 else (None, (at, below))
        below += held
    return (1 << 63) - 1, None


def splitters(rows: DataFrame, shards: int, tolerance: float = 0.002) -> list[Splitter]:
    """Boundaries of ``shards`` runs of nearly equal bytes; each is within ``tolerance`` of a
    shard's size of its target, or beside the one row that holds the target."""
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    goals = [total * i / shards for i in range(1, shards)]
    near = tolerance * total / shards
    found: dict[int, Splitter] = {}
    # of each open splitter: the key its bracket begins at, the exact bytes below that key
    state, bits = {i: (LOWEST, 0) for i in range(len(goals))}, BITS
    while bits and state:
        parts, shift = _probe(rows, "h", sorted({low for low, _ in state.values()}), bits)
        for i, (low, below) in list(state.items()):
            cut, rest = _refine(parts[low], 1 << shift, below, goals[i], near)
            if rest is None:
                found[i] = Splitter(min(cut, (1 << 63) - 1))
                del state[i]
            else:
                state[i] = rest
        bits = shift
    # equal texts that outweigh the tolerance are divided by doc_id
    for i, (h, below) in state.items():
        same, low, bits = rows.where(F.col("h") == h), LOWEST, BITS
        while bits and i not in found:
            parts, shift = _probe(same, "doc_id", [low], bits)
            cut, rest = _refine(parts[low], 1 << shift, below, goals[i], near)
            if rest is None:
                found[i] = Splitter(h, cut)
            else:
                (low, below), bits = rest, shift
        found.setdefault(i, Splitter(h, low))  # rows of one key stay together
    return [found[i] for i in range(len(goals))]


def shard_of(cuts: list[Splitter]) -> Column:
    """Number of splitters at or below the row's key; a null doc_id comes first among equal texts."""
    out = F.lit(0)
    for s in cuts:
        past = F.col("h") >= s.hash if s.doc is None else (
            (F.col("h") > s.hash) | ((F.col("h") == s.hash) & (F.coalesce(F.col("doc_id"), F.lit(LOWEST)) >= s.doc)))
        out = out + past.cast("int")
    return out


def histogram_shards(docs: DataFrame, shards: int = 24, tolerance: float = 0.002, rows_per_slice: int = 200_000,
                     key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row's shard (bytes near equal) and its slot in it, gapless from 0.

    Only keys, sizes and hashes move: they are written once, counted in
    each round, and exchanged once, by (shard, slice).  A slice is a share of
    a shard's doc_ids, so no task numbers more than about ``rows_per_slice``
    rows, also where one text or one shard's range holds a third of all rows.
    A null text weighs 8 bytes; null keys and repeated rows each get a slot; an
    empty table gives no rows.
    """
    rows = stored(keyed(docs, key, text), "shard-keys")
    cuts = splitters(rows, shards, tolerance)
    slices = max(1, -(-rows.count() // (shards * rows_per_slice)))
    placed = rows.withColumns({"shard": shard_of(cuts), "slice": F.pmod(F.xxhash64("doc_id"), F.lit(slices)).cast("int")})
    group = Window.partitionBy("shard", "slice")
    # a row for each shard and slice; joined and numbered on the one exchange of the rows
    held = placed.groupBy("shard", "slice").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    first = held.select("shard", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    order = group.orderBy("h", F.col("doc_id").asc_nulls_first(), "size")
    return (placed.join(first, ["shard", "slice"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("first") + F.row_number().over(order) - 1).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
