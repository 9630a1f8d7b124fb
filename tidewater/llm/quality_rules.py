"""Quality rules with compression bands.

A zstandard ratio (compressed bytes / bytes) over the whole text and over its
fixed chunks places a text in a band: far below it the text repeats itself, far
above it the text is noise.  Short texts compress badly whatever they say, so
the limits depend on the length.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import DataFrame

from tidewater.llm.common import WHITE_SPACE, arrow, map_texts

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Bands:
    """Limits of the ratios.

    whole: (least bytes, lowest ratio, highest ratio) by rising length; a text
    shorter than the first entry gets no verdict.  chunk: the same for one
    chunk of ``chunk_bytes``; a text is rejected when more than
    ``chunk_share`` of its chunks lie outside.
    """

    whole: tuple[tuple[int, float, float], ...] = (
        (64, 0.50, 1.30), (128, 0.36, 1.05), (512, 0.34, 0.90), (1024, 0.32, 0.80), (4096, 0.28, 0.75),
        (16384, 0.22, 0.75))
    chunk_bytes: int = 2048
    chunk: tuple[float, float] = (0.30, 0.80)
    chunk_share: float = 0.5
    level: int = 3


def repeated_words(words: list[bytes], n: int = 5) -> int:
    """Words that lie in an ``n``-word window found twice or more, the first occurrence included."""
    count = len(words) - n + 1
    if count < 2:
        return 0
    codes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    mixed = np.zeros(count, np.uint64)
    for k in range(n):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + codes[k:k + count]
        mixed ^= mixed >> np.uint64(31)
    ordered = np.sort(mixed)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):  # windows with different hashes differ
        return 0
    starts = np.flatnonzero(np.isin(mixed, twice)).tolist()
    windows = [tuple(words[i:i + n]) for i in starts]  # equal hashes are compared word by word
    found = Counter(windows)
    edge = np.zeros(len(words) + 1, np.int32)
    for i, w in zip(starts, windows):
        if found[w] > 1:
            edge[i] += 1
            edge[i + n] -= 1
    return int((np.cumsum(edge[:-1]) > 0).sum())


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    found = text.encode().split()
    lines = [x for x in text.split("\n") if x.strip(WHITE_SPACE)]
    return (len(found), len(text) - sum(map(text.count, WHITE_SPACE)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(found))


def ratios(data: bytes, bands: Bands, packer: zstandard.ZstdCompressor) -> tuple[float, int, int]:
    """Ratio of the whole text; its number of chunks and of chunks outside the band.

    A last chunk under half of the chunk size is left to the whole ratio.
    """
    if not data:
        return 0.0, 0, 0
    low, high = bands.chunk
    chunks = [data[i:i + bands.chunk_bytes] for i in range(0, len(data), bands.chunk_bytes)]
    if len(chunks[-1]) * 2 < bands.chunk_bytes:
        chunks.pop()
    outside = sum(not low <= len(packer.compress(c)) / len(c) <= high for c in chunks)
    return len(packer.compress(data)) / len(data), len(chunks), outside


def in_bands(size: int, whole: float, n_chunks: int, n_outside: int, bands: Bands) -> bool:
    limits = [x for x in bands.whole if size >= x[0]]
    if not limits:
        return True
    _, low, high = limits[-1]
    return low <= whole <= high and n_outside <= bands.chunk_share * n_chunks


def passes(text: str, bands: Bands = Bands()) -> bool:
    """The verdict alone."""
    return judged(text, bands, zstandard.ZstdCompressor(level=bands.level))[-1]


def judged(text: str, bands: Bands, packer: zstandard.ZstdCompressor) -> tuple:
    """n_words and the other base counts, ratio, number of chunks, of chunks outside, base_failed, kept."""
    counts = base_counts(text)
    data = text.encode()
    whole, n_chunks, outside = ratios(data, bands, packer)
    failed = counts[0] < 10 or 100 * counts[4] > 20 * counts[0]
    return *counts, whole, n_chunks, outside, failed, not failed and in_bands(len(data), whole, n_chunks, outside, bands)


SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "ratio double, n_chunks long, n_chunks_outside long, base_failed boolean, kept boolean")


def quality_rules(docs: DataFrame, bands: Bands = Bands(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: base counts, ratios and the verdict.

    No shuffle; each row is judged by itself, so repeated rows get equal rows
    and a null key keeps its verdict.  A null or empty text has no words, fails
    the base rule and has ratio 0.  A very long text is compressed whole.
    Columns other than the two named are not read.
    """
    def judge(keys, texts):
        packer = zstandard.ZstdCompressor(level=bands.level)
        rows = [(k, *judged(x, bands, packer)) for k, x in zip(keys, texts)]
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        return arrow(SCHEMA, **dict(zip(names, zip(*rows))))

    return map_texts(docs, judge, SCHEMA, key, text)
