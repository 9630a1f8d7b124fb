"""Quality scores: random Fourier features, ridge regression, isotonic calibration.

Statistics of each text are standardised and mapped to cosines of random
projections, whose inner products approximate a Gaussian kernel.  The normal
equations of a ridge regression on the labels are summed over partitions; its
values are calibrated by isotonic regression.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import WHITE_SPACE, arrow, map_texts, stored
from tidewater.llm.quality_rules import SYMBOLS, repeated_words

FEATURES = ("log_words", "word_chars", "distinct", "symbols", "dup_lines", "repeats", "ratio", "digits", "upper",
            "stops", "marks", "lines", "ascii_letters", "top_word", "wide", "spaces")
_DIGITS, _UPPER = b"0123456789", bytes(range(65, 91))
_LETTERS, _STOPS, _MARKS = _UPPER + bytes(range(97, 123)), b".,;:", b"!?"


def statistics(text: str, packer: zstandard.ZstdCompressor) -> list[float]:
    """The statistics of a text in the order of FEATURES; all 0 for a text without words."""
    data = text.encode()
    words = data.split()
    if not words:
        return [0.0] * len(FEATURES)
    n, size = len(words), len(data)

    def share(chars: bytes) -> float:
        return (size - len(data.translate(None, chars))) / size

    lines = [x for x in text.split("\n") if x.strip(WHITE_SPACE)]
    counts = Counter(words)
    return [math.log1p(n), sum(map(len, words)) / n, len(counts) / n, sum(map(text.count, SYMBOLS)) / n,
            1 - len(set(lines)) / len(lines), repeated_words(words) / n, len(packer.compress(data)) / size,
            share(_DIGITS), share(_UPPER), share(_STOPS), share(_MARKS), len(lines) / n, share(_LETTERS),
            max(counts.values()) / n, 1 - len(text) / size, sum(map(text.count, WHITE_SPACE)) / size]


STATISTICS = "doc_id long, x array<double>"


def document_statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    def run(keys, texts):
        packer = zstandard.ZstdCompressor(level=1)
        return arrow(STATISTICS, doc_id=keys, x=[statistics(t, packer) for t in texts])

    return map_texts(docs, run, STATISTICS, key, text)


@dataclass(frozen=True)
class Settings:
    """size: number of Fourier features.  width: of the kernel, in standard deviations.
    ridge: weight of the penalty for each row.  bins: of the scores that calibration sees."""

    size: int = 384
    width: float = 3.0
    ridge: float = 1e-3
    bins: int = 2000
    seed: int = 7


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    settings: Settings
    weights: np.ndarray | None = None
    xs: list[float] = field(default_factory=list)
    ys: list[float] = field(default_factory=list)

    def fourier(self, x: np.ndarray) -> np.ndarray:
        """Random Fourier features and a constant; statistics beyond 6 deviations count as 6."""
        random = np.random.default_rng(self.settings.seed)
        w = random.normal(0, 1 / self.settings.width, (x.shape[1], self.settings.size))
        shift = random.uniform(0, 2 * np.pi, self.settings.size)
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.hstack([np.sqrt(2 / self.settings.size) * np.cos(z @ w + shift), np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.fourier(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), 0.5)
        return np.clip(np.interp(self.raw(x), self.xs, self.ys), 0, 1)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


SUMS = "sums binary"


def _add_up(parts: DataFrame, n: int, way: int = 32) -> np.ndarray | None:
    """Sum of the arrays in ``parts`` by rounds in which a task adds ``way`` of them, one at a time."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for x in batch.column(0):
                v = np.frombuffer(x.as_buffer(), np.float64)
                total = v.copy() if total is None else total + v
        if total is not None:
            yield arrow(SUMS, sums=[total.tobytes()])

    while n > 8:
        n = -(-n // way)
        parts = parts.repartition(n).mapInArrow(add, SUMS)
    rows = [np.frombuffer(r[0], np.float64) for r in parts.collect()]
    return sum(rows[1:], rows[0]) if rows else None


def isotonic(groups: list[tuple[float, int, float]]) -> tuple[list[float], list[float]]:
    """Pool adjacent violators: (x, rows, mean label) by rising x to a rising step through (x, y)."""
    pools: list[list[float]] = []  # rows, label, first x, last x
    for x, n, y in groups:
        pools.append([n, y, x, x])
        while len(pools) > 1 and pools[-2][1] >= pools[-1][1]:
            n2, y2, _, last = pools.pop()
            n1, y1, first, _ = pools[-1]
            pools[-1] = [n1 + n2, (n1 * y1 + n2 * y2) / (n1 + n2), first, last]
    xs = [v for p in pools for v in ((p[2], p[3]) if p[3] > p[2] else (p[2],))]
    ys = [p[1] for p in pools for _ in range(2 if p[3] > p[2] else 1)]
    return xs, ys


def fit(features: DataFrame, labelled: DataFrame, settings: Settings = Settings()) -> Model:
    """``features``: doc_id, x of all documents.  ``labelled``: x, y (0 or 1) of the rows to learn from.

    Means and deviations cover all documents; every labelled row counts.  The
    driver gets sums whose size depends on the settings alone.  Without labels
    the model scores 0.5; with one class it scores that.
    """
    k = len(FEATURES)
    row = features.agg(*(f(F.col("x")[i]) for i in range(k) for f in (F.avg, F.stddev_pop))).first()
    mean, dev = (np.array([v or 0.0 for v in row[i::2]]) for i in (0, 1))
    model = Model(mean, np.where(dev > 1e-12, dev, 1.0), settings)
    m = settings.size + 1

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, rows = np.zeros((m, m)), np.zeros(m), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                z = model.fourier(_matrix(part.column(0)))
                a += z.T @ z
                b += z.T @ part.column(1).to_numpy(zero_copy_only=False)
                rows += len(z)
        if rows:
            yield arrow(SUMS, sums=[np.concatenate([a.ravel(), b, [rows]]).tobytes()])

    some = labelled.select("x", F.col("y").cast("double").alias("y"))
    partial = stored(some.mapInArrow(sums, SUMS), "normal-equations")
    total = _add_up(partial, partial.count())
    if total is None:
        return model
    a, b, rows = total[:m * m].reshape(m, m), total[m * m:-1], total[-1]
    penalty = settings.ridge * rows * np.eye(m) / m
    model.weights = np.linalg.solve(a + penalty + 1e-9 * np.eye(m), b)

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = model.raw(_matrix(batch.column(0)))
            b = np.clip(np.floor((s + 0.5) / 2 * settings.bins), 0, settings.bins - 1).astype(np.int64)
            yield arrow("b long, s double, y double", b=b, s=s, y=batch.column(1))

    held = (some.mapInArrow(binned, "b long, s double, y double").groupBy("b")
            .agg(F.avg("s").alias("s"), F.count("*").alias("n"), F.avg("y").alias("y")).collect())  # bins rows at most
    model.xs, model.ys = isotonic([(r["s"], r["n"], r["y"]) for r in sorted(held, key=lambda r: r["s"])])
    return model


SCORES = "doc_id long, score double"


def quality_scores(docs: DataFrame, labels: DataFrame, label: str = "quality", hold_out: int | None = 5,
                   settings: Settings = Settings(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score (0 to 1) of every row; only rows not held out teach.

    held_out: crc32 of the doc_id as text is divisible by ``hold_out`` (a null
    doc_id counts as an empty text).  A null or empty text has the statistics 0
    and a score like any other; labels other than 0 and 1 and null keys are
    left out; repeated rows and labels each count.
    """
    held = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(hold_out or 1)) == 0
    features = stored(document_statistics(docs, key, text), "text-statistics")
    taught = labels.where(F.col(label).isin(0, 1)).select(F.col(key).alias("doc_id"), F.col(label).alias("y"))
    labelled = features.join(taught, "doc_id")
    model = fit(features, labelled.where(~held) if hold_out else labelled, settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield arrow(SCORES, doc_id=batch.column(0), score=model.score(_matrix(batch.column(1))))

    scored = features.select("doc_id", "x").mapInArrow(run, SCORES)
    return scored.select("doc_id", (held if hold_out else F.lit(False)).alias("held_out"), "score")
