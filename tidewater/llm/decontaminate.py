"""Benchmark decontamination by latent semantic retrieval.

Passages of the corpus and benchmark items are TF-IDF vectors over the
benchmark's words.  A randomised SVD of the passages, its products summed over partitions, gives the
corpus's leading directions; with the items' own they span the latent space.

Every passage is compared there with every item of its length.  Candidates come from the product of the item with
the item's words that the passage holds, so what surrounds the item in a passage does not count.  The limit of each item follows
from the rule for hits: a hit holds all but so many of the item's words, and however their weights fall, the product is at least
that of the lightest words that may be left.  The item's direction lies in the space, so no projection lowers
the product, and no hit is lost.  For every candidate the longest common subsequence of words and the item's answer part
decide; the cosine of the whole passage in the space ranks equal ones.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import WHITE_SPACE, arrow, handing_back, spans_of_rows, stored
from tidewater.llm.quality_classifier import _add_up

#: Words a worker remembers before it starts anew.
REMEMBERED = 400_000


@dataclass(frozen=True)
class Settings:
    """block: items searched at a time.  copy: share of an item's words in the common subsequence that
    tells by itself; paraphrase: that tells if ``answer`` of the answer part (the last fifth, three words at
    least) is found too.  common: a word in more than this share of documents is a feature only if the
    features of an item would else not tell ``least`` words of a hit; common and least bear on the work alone, no hit
    is lost by them."""

    block: int = 256
    common: float = 0.01
    least: int = 8
    copy: float = 0.8
    paraphrase: float = 0.6
    answer: float = 0.8
    rank: int = 48
    oversample: int = 16
    seed: int = 3


#: Marks that may stand at the ends of a word.
MARKS = string.punctuation + "\u2018\u2019\u201c\u201d\u00ab\u00bb\u2026\u2013\u2014\u00bf\u00a1"
ASCII_MARKS = string.punctuation.encode()
#: By byte: white space, marks, lower case; by length: the bytes of a number that count.
WHITE, MARK = (np.isin(np.arange(256), list(x)) for x in (WHITE_SPACE.encode(), ASCII_MARKS))
LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
#: Passages that are multiplied at a time.
MULTIPLIED = 64


def plain(word: str) -> str:
    """A word in lower case without marks at its ends."""
    return word.strip(MARKS).lower()


class Vocabulary(dict):
    """Raw word (bytes) to feature number, -1 for others; remembers what it has looked up.

    ASCII words of 16 bytes at most are looked up together, in a hash table whose entries are compared in full.
    """

    SLOTS = 1 << 16

    def __init__(self, words: dict[str, int]):
        super().__init__()
        self.words = words
        self.ascii = {w.encode(): n for w, n in words.items() if w.isascii()}
        self.dtype = np.int16 if len(words) < 1 << 15 else np.int32
        # short words as two integers and a length, in lists by slot
        short = [w for w in self.ascii if len(w) <= 16]
        self.number = np.array([self.ascii[w] for w in short], np.int64)
        self.size = np.array([len(w) for w in short], np.int64)
        self.halves = np.frombuffer(b"".join(w.ljust(16, b"\0") for w in short), np.uint64).reshape(-1, 2).T.copy()
        self.head, self.after = np.full(self.SLOTS, -1), np.full(len(short), -1)
        for k, slot in enumerate(self.slots(*self.halves).tolist()):
            self.after[k], self.head[slot] = self.head[slot], k

    def slots(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return ((low * np.uint64(0x9E3779B97F4A7C15) ^ high * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(48)).astype(np.int64)

    def __missing__(self, raw: bytes) -> int:
        if raw.isascii():
            n = self.ascii.get(raw.strip(ASCII_MARKS).lower(), -1)
        else:
            n = self.words.get(plain(raw.decode()), -1)
        self[raw] = n
        return n

    def numbers(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all words of ``texts``, one text after the other, and the words of each (null: none)."""
        if len(self) > REMEMBERED:
            self.clear()
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        whole = bytes(memoryview(texts.buffers()[2] or b"")[offsets[0]:offsets[-1]])
        offsets = offsets - offsets[0]
        data = np.frombuffer(whole, np.uint8)
        if not len(data):
            return np.empty(0, self.dtype), np.zeros(len(texts), np.int64)
        # a word begins or ends at white space, and where a text does
        space = np.ones(len(data) + 1, bool)
        space[:-1] = WHITE[data]
        first = ~space[:-1]
        last = first.copy()
        inner = np.unique(offsets[(offsets > 0) & (offsets < len(data))])
        first[1:] &= space[:-2]
        first[inner] = ~space[inner]
        last &= space[1:]
        last[inner - 1] = ~space[inner - 1]
        begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        counts = np.diff(np.searchsorted(begin, offsets))
        if not len(begin):
            return np.empty(0, self.dtype), counts
        left, right = begin.copy(), end.copy()
        todo = np.arange(len(begin))
        while len(todo := todo[MARK[data[left[todo]]]]):
            left[todo] += 1
            todo = todo[left[todo] < right[todo]]
        todo = np.flatnonzero(left < right)
        while len(todo := todo[MARK[data[right[todo] - 1]]]):
            right[todo] -= 1
        size = right - left
        low = np.zeros(len(data) + 16, np.uint8)
        low[:len(data)] = LOWER[data]
        eight = np.ndarray(len(data) + 9, np.uint64, low, strides=(1,))
        halves = eight[left] & BYTES[np.minimum(size, 8)], eight[left + 8] & BYTES[np.clip(size - 8, 0, 8)]
        at = self.head[self.slots(*halves)]
        todo = np.flatnonzero(at >= 0)
        while len(todo):
            k = at[todo]
            same = (halves[0][todo] == self.halves[0][k]) & (halves[1][todo] == self.halves[1][k]) & (size[todo] == self.size[k])
            todo = todo[~same]
            at[todo] = self.after[at[todo]]
            todo = todo[at[todo] >= 0]
        out = np.r_[self.number, -1][at].astype(self.dtype)
        others = np.flatnonzero((size > 16) | (np.bitwise_or.reduceat(data, begin) >= 128))
        raw = map(whole.__getitem__, map(slice, begin[others].tolist(), end[others].tolist()))
        out[others] = np.fromiter(map(self.__getitem__, raw), self.dtype, len(others))
        return out, counts


def places_of(a: list[int]) -> dict[int, int]:
    """The places of each word as bits."""
    places: dict[int, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    return places


def common_subsequence(a: list[int], b: list[int], places: dict[int, int] | None = None) -> int:
    """Length of the longest common subsequence; bits stand for the places of ``a``, which may be given."""
    places = places_of(a) if places is None else places
    full = (1 << len(a)) - 1
    row = full
    for x in b:
        if m := places.get(x):
            u = row & m
            row = ((row + u) | (row - u)) & full
    return len(a) - row.bit_count()


def reach(n: int) -> int:
    """The power of two, 64 at least, that bounds an item of ``n`` words; its passages are cut for that length."""
    return max(64, 1 << (n - 1).bit_length())


class Block:
    """Some items as sequences of word numbers, and how passages are cut for them.

    Items of like length form a group with passages of its own, so a passage depends on the item's own
    length and not on the others of the block.
    """

    def __init__(self, items: list[tuple[int, str]], settings: Settings):
        self.settings = settings
        self.words: dict[str, int] = {}
        self.items = []
        for item, text in items:
            found = [w for w in map(plain, (x.decode() for x in (text or "").encode().split())) if w]
            if found and item is not None:
                self.items.append((item, [self.words.setdefault(w, len(self.words)) for w in found]))
        lengths, self.group = np.unique([reach(len(s)) for _, s in self.items], return_inverse=True)
        self.strides = [int(n) // 2 for n in lengths]
        self.spans = [-(-(stride + stride * 5 // 2) // stride) for stride in self.strides]  # strides in a passage
        self.idf = np.zeros(len(self.words))

    def weigh(self, df: np.ndarray, n_docs: int) -> None:
        """Features by document frequency, their weights, and the limit of each item.

        A hit lacks at most ``lost`` of an item's words.  So of any of its words it holds all but ``lost``, whichever
        are taken as features: the rarest serve best, and the frequencies bear on the work alone.  ``asked`` is the share of the
        item's squared length that a hit holds at least: what is left when ``lost`` words go, the heaviest for
        each word being lost first (the last one in part).
        """
        idf = np.log((n_docs + 1) / (df + 1)) + 1e-6
        rare = df <= self.settings.common * n_docs
        self.kept = np.zeros((len(self.strides), len(self.words) + 1), bool)  # the last column is that of other words
        lost = [len(s) - math.ceil(self.settings.paraphrase * len(s) - 1e-9) for _, s in self.items]
        for (_, s), group, n in zip(self.items, self.group, lost):
            self.kept[group, sorted(s, key=lambda w: (df[w], w))[:max(int(rare[s].sum()), n + self.settings.least)]] = True
        self.idf = np.where(self.kept.any(0)[:-1], idf, 0)
        vectors, self.asked = self.item_matrix(), np.zeros(len(self.items))
        for i, (_, s) in enumerate(self.items):
            words, times = np.unique(s, return_counts=True)
            square = np.where(self.kept[self.group[i], words], vectors[i, words] ** 2, 0)
            order = np.argsort(-square / times, kind="stable")
            square, times = square[order], times[order]
            gone = np.clip(lost[i] - (np.cumsum(times) - times), 0, times) / times
            # sums of that many terms in single precision are right to less than the part taken off
            self.asked[i] = ((1 - gone) * square).sum() * (1 - 1e-6 * len(words))

    def item_matrix(self) -> np.ndarray:
        d = np.zeros((len(self.items), len(self.words)))
        for i, (_, s) in enumerate(self.items):
            np.add.at(d[i], s, 1)
        d = d * self.idf
        return d / np.maximum(np.linalg.norm(d, axis=1, keepdims=True), 1e-12)

    def passages(self, words: np.ndarray, counts: np.ndarray, group: int):
        """(document, first stride, features, counts, offsets) of a group's passages that have features.

        ``words`` are those of documents of ``counts`` words, one after the other.
        """
        span, spans = self.strides[group], self.spans[group]
        last = np.maximum(-(-counts // span) - spans, 0)
        base = np.cumsum(last + 1) - (last + 1)  # passages of earlier documents
        begin = np.cumsum(counts) - counts
        at = np.flatnonzero(self.kept[group][words])
        doc = np.repeat(np.arange(len(counts)), counts)[at]
        stride, own = (at - begin[doc]) // span, words[at].astype(np.int64)
        n, last = len(self.words), last[doc]
        keys = []
        for k in range(min(spans, int(stride.max(initial=0)) + 1)):
            in_it = np.flatnonzero((stride >= k) & (stride - k <= last))
            keys.append((base[doc[in_it]] + stride[in_it] - k) * n + own[in_it])
        key = np.sort(np.concatenate(keys))
        cut = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
        tf = np.diff(np.r_[cut, len(key)])
        passage, w = np.divmod(key[cut], max(n, 1))
        row = np.flatnonzero(np.r_[True, passage[1:] != passage[:-1]]) if len(key) else cut
        d = np.searchsorted(base, passage[row], "right") - 1
        return d, passage[row] - base[d], w, tf, np.r_[row, len(passage)]


NUMBERED = "doc long, words binary, sums binary"


def _numbered(docs: DataFrame, block: Block) -> DataFrame:
    """Each document as the numbers of its words, and a row a task with its documents and those that have each word."""
    words = block.words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, n = Vocabulary(words), max(len(words), 1)
        df = np.zeros(1 + n)
        for batch in batches:
            for part in spans_of_rows(batch, "text"):
                numbers, counts = vocabulary.numbers(part.column("text"))
                df[0] += len(counts)
                doc = np.repeat(np.arange(len(counts)) * n, counts)
                cells = np.sort((doc + numbers)[numbers >= 0])
                if len(cells):
                    df[1:] += np.bincount(cells[np.r_[True, cells[1:] != cells[:-1]]] % n, minlength=n)
                ends = np.r_[0, np.cumsum(counts)] * numbers.itemsize
                column = pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(numbers)])
                yield pa.RecordBatch.from_arrays([part.column("doc"), column, pa.nulls(len(counts), pa.binary())], ["doc", "words", "sums"])
        yield arrow(NUMBERED, doc=[None], words=[None], sums=[df.tobytes()])

    return docs.mapInArrow(handing_back(run), NUMBERED)


def _numbers(batch: pa.RecordBatch, block: Block) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of numbered documents, their words one after the other, and the words of each."""
    dtype = np.dtype(np.int16 if len(block.words) < 1 << 15 else np.int32)
    for part in spans_of_rows(batch, "words"):
        column = part.column("words")
        offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
        yield part, np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]].view(dtype), np.diff(offsets) // dtype.itemsize


VECTORS = "doc long, first int, words array<int>, tf array<int>"


def _listed(batch: pa.RecordBatch):
    """(words, counts, offsets) of a batch of VECTORS."""
    words = batch.column("words")
    offsets = words.offsets.to_numpy()
    yield words.flatten().to_numpy(zero_copy_only=False), batch.column("tf").flatten().to_numpy(zero_copy_only=False), offsets - offsets[0]


def _cut(block: Block):
    """(words, counts, offsets) of the passages of a batch of numbered documents."""
    def parts(batch: pa.RecordBatch):
        for _, numbers, counts in _numbers(batch, block):
            for group in range(len(block.strides)):
                yield block.passages(numbers, counts, group)[2:]

    return parts


def _weights(w: np.ndarray, tf: np.ndarray, offsets: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Weights of vectors, each of length 1.

    The term frequency counts by its logarithm, so a word said over and over doesn't drown an item."""
    x = idf[w] * (1 + np.log(tf))
    norm = np.sqrt(np.add.reduceat(x * x, offsets[:-1]))
    return (x / np.repeat(norm, np.diff(offsets))).astype(np.float32)


def _dense(w: np.ndarray, x: np.ndarray, offsets: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Some vectors at a time: the first one's place, the words that they have, and the vectors over these words."""
    has, place, sizes = np.zeros(n, bool), np.zeros(n, np.int64), np.diff(offsets)
    for at in range(0, len(sizes), MULTIPLIED):
        some = slice(offsets[at], offsets[min(at + MULTIPLIED, len(sizes))])
        has[w[some]] = True
        own = np.flatnonzero(has)
        has[own], place[own] = False, np.arange(len(own))
        few = sizes[at:at + MULTIPLIED]
        a = np.zeros((len(few), len(own)), np.float32)
        a[np.repeat(np.arange(len(few)), few), place[w[some]]] = x[some]
        yield at, own, a


def randomised_svd(vectors: DataFrame, idf: np.ndarray, settings: Settings, parts=_listed) -> np.ndarray:
    """Leading right singular vectors (words x rank) of the matrix whose rows are ``vectors``.

    ``parts`` gives the vectors of a batch.  One distributed pass sums A'(A omega) for a random omega over partitions;
    the Nystroem form of A'A then gives the singular vectors.  Sums have words x (rank +
    oversample) numbers, whatever the number of rows.
    """
    n, width = len(idf), settings.rank + settings.oversample
    omega = np.random.default_rng(settings.seed).normal(size=(n, width)).astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n, width))
        for batch in batches:
            for w, tf, offsets in parts(batch):
                if len(w):
                    for _, own, a in _dense(w, _weights(w, tf, offsets, idf), offsets, n):
                        total[own] += a.T @ (a @ omega[own])
        yield arrow("sums binary", sums=[total.tobytes()])

    sums = stored(vectors.mapInArrow(handing_back(run), "sums binary"), "svd-sums")
    total = _add_up(sums, sums.count())
    if total is None or not total.any():
        return np.zeros((n, 0))
    s = total.reshape(n, width)
    # A'A is about s (omega' s)^-1 s'; a small shift keeps the inverse stable
    shift = 1e-7 * np.linalg.norm(s)
    s = s + shift * omega
    core = omega.T.astype(float) @ s
    values, basis = np.linalg.eigh((core + core.T) / 2)
    good = values > 1e-10 * max(values.max(), 1e-300)
    left, sigma, _ = np.linalg.svd(s @ (basis[:, good] / np.sqrt(values[good])), full_matrices=False)
    return left[:, :settings.rank][:, sigma[:settings.rank] ** 2 > 2 * shift]


HITS = "doc_id long, item_id long, share double, answer_share double, cosine double, start long"


class Space:
    """The latent space of a block: the items' directions and those of ``directions``, orthonormal."""

    def __init__(self, block: Block, directions: np.ndarray):
        items = block.item_matrix().T
        space, _ = np.linalg.qr(np.hstack([items, directions]))
        places = space.T @ items
        product = space @ places
        product *= items  # what a word of an item adds to the product of the item and a passage that holds the word
        self.space = space.astype(np.float32)
        self.groups = []
        for group in range(len(block.strides)):
            i = np.flatnonzero(block.group == group)
            self.groups.append((i, product[:, i].astype(np.float32), places[:, i].astype(np.float32), block.asked[i]))

    def near(self, group: int, w: np.ndarray, x: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(passages, items, cosines) of the candidates among all pairs of passages and items of one group.

        The item's words that a passage holds, each with the item's weight, have as squared length their share of the item's:
        in the space their product with the item is that share too, its root their cosine.  It is held against
        the item's limit.  The cosines returned are those of whole passages in the space.
        """
        items, product, places, asked = self.groups[group]
        for at, own, a in _dense(w, x, offsets, len(self.space)):
            z = a @ self.space[own]
            cosine = z @ places / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)
            share = (a > 0).astype(np.float32) @ product[own]
            row, i = np.nonzero((share >= asked) & (share > 0))
            yield at + row, items[i], cosine[row, i]


def _hits(numbered: DataFrame, block: Block, directions: np.ndarray) -> DataFrame:
    """Hits, one row for an item and document, the best passage.

    Every passage is compared with every item of its group in the latent space, and every candidate by words.
    """
    settings, idf, space = block.settings, block.idf, Space(block, directions)

    def found(words: list[int], places: dict[int, int], passage: list[int]) -> tuple[float, float] | None:
        share = common_subsequence(words, passage, places) / len(words)
        if share < settings.paraphrase:
            return None
        answer = words[-max(3, -(-len(words) // 5)):]
        part_found = common_subsequence(answer, passage) / len(answer)
        return (share, part_found) if share >= settings.copy or part_found >= settings.answer else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = [places_of(words) for _, words in block.items]
        has = np.zeros((len(places), len(block.words) + 1), bool)  # words of no item are in the last column
        for i, own in enumerate(places):
            has[i, list(own)] = True
        for batch in batches:
            for part, numbers, counts in _numbers(batch, block):
                begin, end = np.cumsum(counts) - counts, np.cumsum(counts)
                best: dict[tuple[int, int], tuple] = {}
                for group in range(len(block.strides)):
                    d, first, w, tf, offsets = block.passages(numbers, counts, group)
                    if not len(d):
                        continue
                    stride = block.strides[group]
                    for near in space.near(group, w, _weights(w, tf, offsets, idf), offsets):
                        for row, i, cosine in zip(*(x.tolist() for x in near)):
                            item, words = block.items[i]
                            k, start = int(d[row]), int(first[row]) * stride
                            passage = numbers[begin[k] + start:min(begin[k] + start + stride * block.spans[group], end[k])]
                            if shares := found(words, places[i], passage[has[i][passage]].tolist()):
                                hit = (*shares, cosine, -start)
                                best[k, item] = max(best.get((k, item), hit), hit)
                if best:
                    keys = part.column("doc").to_pylist()
                    names = [x.split()[0] for x in HITS.split(", ")]
                    rows = [(keys[k], item, a, b, c, -s) for (k, item), (a, b, c, s) in best.items()]
                    yield arrow(HITS, **dict(zip(names, zip(*rows))))

    return numbered.mapInArrow(handing_back(run), HITS)


def contaminated(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings(), key: str = "doc_id",
                 text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, share, answer_share, cosine, start) of the items found in documents.

    The items are the stated query set; they are taken in blocks of ``settings.block``,
    each against all passages of all documents.  Null or empty items and
    texts match nothing, rows with a null key are searched and returned with it; repeated rows of a document or an
    item give one hit; no rows or no items give none.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    items = benchmark.select(F.col(item_key).cast("long").alias("item"), F.col(item_text).alias("text")).where(
        "item is not null and text is not null").distinct().orderBy("item", "text")
    hits, block_rows = [], []
    for r in items.toLocalIterator():
        block_rows.append((r["item"], r["text"]))
        if len(block_rows) == settings.block:
            hits.append(_block_hits(rows, Block(block_rows, settings)))
            block_rows = []
    if block_rows or not hits:
        hits.append(_block_hits(rows, Block(block_rows, settings)))
    out = hits[0]
    for h in hits[1:]:
        out = out.union(h)
    best = F.max(F.struct("share", "answer_share", "cosine", (-F.col("start")).alias("s"))).alias("b")
    return out.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", "b.share", "b.answer_share", "b.cosine", (-F.col("b.s")).alias("start"))


def _block_hits(rows: DataFrame, block: Block) -> DataFrame:
    if not block.items:
        return rows.sparkSession.createDataFrame([], HITS)
    numbered = stored(_numbered(rows, block), "numbered-documents")
    sums = numbered.where("sums is not null").select("sums")
    df = _add_up(sums, sums.count())
    df = np.zeros(1 + len(block.words)) if df is None else df
    block.weigh(df[1:].astype(np.int64), int(df[0]))
    words = numbered.where("words is not null").select("doc", "words")
    return stored(_hits(words, block, randomised_svd(words, block.idf, block.settings, _cut(block))), "benchmark-hits")
