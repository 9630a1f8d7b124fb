"""Periodic run detection: an online dynamic program over sparse diagonals.

A run is a stretch of consecutive words with smallest period q that no neighbouring
word extends: at least ``shortest`` words and three periods long.  The word at i and an
equal earlier one at j are a cell of the diagonal of lag i - j.  Words are taken in
order; each earlier occurrence of a word starts a diagonal or lengthens an active
one, and a diagonal that ends long enough emits its run there and then.

An occurrence starts a diagonal only if it can become a run.  A run of period q
matches itself at lag q over two periods, so it shows as equal word sequences of width w at that lag,
for the power of two w with w/2 < q <= w (16 at least).  If a sequence of width w occurs at two
lags p < p' of this range, both p and p' - p are periods of it, so their greatest common divisor is one too
and p' is no smallest period: the nearest occurrence is enough.  This leaves at
most one start for each word and width, and a number of active diagonals that grows with the
logarithm of the text, also where one word fills a whole text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import handing_back, spans_of_rows

#: Three periods make a run, and so many words.
TIMES, SHORTEST = 3, 24
#: Width of the narrowest sequences: runs of 24 words match themselves over 16 words at every lag up to 8.
NARROWEST = 16


def word_codes(texts: list[str]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """Words of each text; their codes, one after the other and different in different texts; first word of each text."""
    split = [x.encode().split() for x in texts]
    first = np.cumsum([0] + [len(w) for w in split])
    parts, used = [], 0
    for words in split:
        codes: dict[bytes, int] = {}
        parts.append(np.array([codes.setdefault(w, len(codes)) for w in words], np.int64) + used)
        used += len(codes)
    return split, np.concatenate([*parts, np.empty(0, np.int64)]), first


def repeated(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``names`` occur twice or more, and their dense codes."""
    _, codes, counts = np.unique(names, return_inverse=True, return_counts=True)
    again = counts[codes] > 1
    return again, codes[again]


def nearest_before(names: np.ndarray, at: np.ndarray, least: int) -> np.ndarray:
    """Of each (name, place) the greatest place of the same name at most place - least, or -1; places ascend."""
    span = int(at[-1]) + 1
    cells = names * span + at
    order = np.sort(cells)
    wanted = cells - least
    found = np.searchsorted(order, wanted, "right") - 1
    hit = order[np.maximum(found, 0)]
    return np.where((found >= 0) & (at >= least) & (hit // span == names), hit % span, -1)


def diagonal_starts(codes: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """(word, lag) of every diagonal that can become a run, in order of the words.

    Sequences are named exactly, by doubling: two names of width w make one of width 2w, and
    only sequences that occur again are followed.  ``longest``: words of the longest text.
    """
    names, at, width, out = codes, np.arange(len(codes)), 1, []
    again = np.bincount(codes)[codes] > 1 if len(codes) else np.empty(0, bool)
    names, at = names[again], at[again]
    while len(at) and (width <= NARROWEST or width // 2 < longest // TIMES):
        if width >= NARROWEST:
            least = 1 if width == NARROWEST else width // 2 + 1
            before = nearest_before(names, at, least)
            ok = (before >= 0) & (at - before <= width)
            i, lag = at[ok], at[ok] - before[ok]
            j = i - lag
            new = (j == 0) | (codes[i - 1] != codes[j - 1])
            out.append((i[new], lag[new]))
        full = np.full(int(at[-1]) + width + 1, -1, np.int64)
        full[at] = names
        after = full[at + width]
        some = after >= 0
        names, at = names[some] * (int(names.max()) + 1) + after[some], at[some]
        again, names = repeated(names)
        at, width = at[again], 2 * width
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    i, lag = (np.concatenate(x) for x in zip(*out))
    order = np.lexsort((lag, i))
    return i[order], lag[order]


def online_runs(words: list, starts: Iterator[tuple[int, int]], shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of ``words``, sorted; ``starts``: (word, lag) in order."""
    out: list[tuple[int, int, int]] = []
    active: dict[int, int] = {}  # lag: words that the diagonal has matched
    coming = iter(starts)
    ahead = next(coming, None)
    i, n = 0, len(words)
    while ahead or active:
        if not active:
            i = ahead[0]
        while ahead and ahead[0] == i:
            active.setdefault(ahead[1], 0)
            ahead = next(coming, None)
        ended = [p for p in active if i == n or words[i] != words[i - p]]
        if ended:
            told = set()
            for p in sorted(ended):
                matched = active.pop(p)
                start, length = i - matched - p, matched + p
                # the same stretch at a multiple of its period is told already
                if length >= max(shortest, TIMES * p) and start not in told:
                    told.add(start)
                    out.append((start, length, p))
        for p in active:
            active[p] += 1
        i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def strongest(runs: list[tuple[int, int, int]]) -> int | None:
    """Index of the run of greatest length / period, exactly; ties: smallest start, then period, which come first."""
    best = None
    for k, (_, length, period) in enumerate(runs):
        if best is None or length * runs[best][2] > runs[best][1] * period:
            best = k
    return best


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """``words`` without those that a run contains after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    gone = np.cumsum(edge[:-1]) > 0
    return b" ".join([w for w, g in zip(words, gone.tolist()) if not g])


RUNS = ("doc_id long, n_words long, starts array<long>, lengths array<long>, periods array<long>, "
        "strongest int, collapsed string")


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str | Column = "text", shortest: int = SHORTEST) -> DataFrame:
    """Per row: doc_id, n_words, the runs of its whole text (``starts``, ``lengths``, ``periods``, by start,
    then period), the index of the run of greatest length / period (null: no run) and the text with runs collapsed to one period.

    One pass, no shuffle; a task holds 2 MB of texts, or one longer text.  ``shortest``: words of the
    shortest run (24 or more).  A null or empty text has no words and no runs, its collapsed text is empty;
    repeated rows and null keys each give a row; no rows give none; other columns are not read.
    """
    if shortest < SHORTEST:
        raise ValueError(f"runs are found from {SHORTEST} words on")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in spans_of_rows(batch, "text"):
                split, codes, first = word_codes([x or "" for x in part.column(1).to_pylist()])
                at, lag = diagonal_starts(codes, max(map(len, split), default=0))
                edges = np.searchsorted(at, first)
                rows: list[tuple] = []
                for k, words in enumerate(split):
                    a, b = edges[k], edges[k + 1]
                    runs = online_runs(words, zip((at[a:b] - first[k]).tolist(), lag[a:b].tolist()), shortest) if a < b else []
                    rows.append((len(words), *([r[c] for r in runs] for c in range(3)), strongest(runs),
                                 collapse(words, runs).decode()))
                lists = pa.list_(pa.int64())
                kinds = (pa.int64(), lists, lists, lists, pa.int32(), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(c, t) for c, t in zip(zip(*rows), kinds))],
                    [x.split()[0] for x in RUNS.split(", ")])

    text = F.col(text) if isinstance(text, str) else text
    return docs.select(F.col(key).cast("long").alias("key"), text.alias("text")).mapInArrow(handing_back(run), RUNS)


def run_digests(found: DataFrame) -> DataFrame:
    """``found`` as counts, the strongest run and digests of all runs and of the collapsed text."""
    start, length, period = (F.get(c, F.col("strongest")) for c in ("starts", "lengths", "periods"))
    lines = F.transform(F.arrays_zip("starts", "lengths", "periods"), lambda r: F.concat(
        F.concat_ws(",", r["starts"], r["lengths"], r["periods"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("starts").cast("long").alias("n_runs"), start.alias("start"), length.alias("length"),
        period.alias("period"), F.floor(F.lit(1000) * length / period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def with_periods(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text) where the text of every key with crc32(key) % 10 = 0 becomes periodic from some word on.

    h = crc32 of the decimal key, g = h div 10; of n words, word i >= a becomes word a + (i - a) % p with
    a = g % n and p = 1 + (n - a) div (3 + g % 8); words are joined by one space.  Other texts, and those of null keys, stay.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = rows.withColumn("h", F.crc32(F.col("doc_id").cast("string").cast("binary")))
    rows = rows.withColumn("w", F.expr(r"CASE WHEN h % 10 = 0 THEN regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0) END"))
    rows = rows.withColumns({"n": F.size("w"), "g": F.expr("h div 10")}).withColumn(
        "a", F.expr("CASE WHEN n > 0 THEN CAST(g % n AS INT) END"))
    rows = rows.withColumn("p", F.expr("CAST(1 + (n - a) div (3 + g % 8) AS INT)"))
    tail = F.expr("slice(flatten(array_repeat(slice(w, a + 1, p), CAST((n - a + p - 1) div p AS INT))), 1, n - a)")
    return rows.select("doc_id", F.when(F.col("n") > 0, F.array_join(F.concat(F.expr("slice(w, 1, a)"), tail), " "))
                       .otherwise(F.col("text")).alias("text"))
