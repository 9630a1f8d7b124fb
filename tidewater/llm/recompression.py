"""Substring deduplication by recompression.

Rounds replace pairs of neighbouring symbols by names.  A name is a hash of
what it stands for, so every task of the cluster gives equal token sequences
equal names; which neighbours pair depends on the two symbols alone (one of the left kind
before one of the right kind), so equal substrings have the same interior symbols
wherever they lie.  Equal neighbours are of one kind and never pair, so a run
stays a run of one name and is named as a whole by the phrases below.

After two rounds a window of 20 words holds at least four symbols that its own
words determine.  Its phrase is the least name of four such symbols in a row: equal windows have
equal phrases.  A phrase that occurs once in the corpus rules its windows out;
windows of shared phrases are compared with each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import arrow, handing_back, spans_of_rows, stored
from tidewater.llm.ngram_join import REMEMBERED, WordHashes, mixed

STEP = np.uint64(0x9E3779B97F4A7C15)
KINDS = (np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F))
PHRASE = 4


def name_pairs(names: np.ndarray, doc: np.ndarray, round_: int):
    """One round: (left, first, names, index): kind of each symbol, index of each new symbol's first
    part, the new names, and the new symbol that each old one went into."""
    left = (mixed(names ^ KINDS[round_]) >> np.uint64(17)) & np.uint64(1) == 1
    pair = left[:-1] & ~left[1:] & (doc[:-1] == doc[1:])
    second = np.r_[False, pair][:len(names)]
    first = np.flatnonzero(~second)
    paired = np.r_[pair, False][:len(names)][first]
    new = mixed(names[first] + np.uint64(round_ + 1))
    at = first[paired]
    new[paired] = mixed(mixed(names[at] * STEP + np.uint64(round_ + 1)) + names[at + 1])
    return left, first, new, np.cumsum(~second) - 1


def rows_of(x: np.ndarray, n: int) -> np.ndarray:
    """Names of ``n`` neighbours (n: 4) from every index on; those past the end are cut."""
    out = x[:len(x) - n + 1].copy()
    for k in range(1, n):
        out = mixed(out * STEP + x[k:len(x) - n + 1 + k])
    return out


def least_in(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Index of the first least value of each range [start, end), none longer than 31."""
    tables, width = [np.arange(len(values))], 1
    longest = int((end - start).max(initial=1))
    while 2 * width <= longest:
        t = tables[-1]
        a, b = t[:len(t) - width], t[width:]
        tables.append(np.where(values[a] <= values[b], a, b))
        width *= 2
    out = np.empty(len(start), np.int64)
    power = np.floor(np.log2(end - start)).astype(np.int64)
    for k, t in enumerate(tables):
        at = np.flatnonzero(power == k)
        a, b = t[start[at]], t[end[at] - (1 << k)]
        out[at] = np.where(values[a] <= values[b], a, b)
    return out


def phrases(h: np.ndarray, doc: np.ndarray, starts: np.ndarray, window: int):
    """For each window (its first word in ``starts``): its phrase's name and the word it begins at."""
    left1, first1, names1, index1 = name_pairs(mixed(h), doc, 0)
    left2, first2, names2, index2 = name_pairs(names1, doc[first1], 1)
    # what the words themselves determine: not a first symbol of the right kind, nor a last one of the left kind
    a = index1[starts + ~left1[starts]]
    b = index1[starts + window - 1 - left1[starts + window - 1]] + 1
    a, b = a + ~left2[a], b - left2[b - 1]
    from_, to = index2[a], index2[b - 1] + 1
    names = rows_of(names2, PHRASE)
    at = least_in(names, from_, to - PHRASE + 1)
    return names[at], first1[first2[at]]


def window_names(h: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent names (64 and 32 bits) of every run of ``window`` words."""
    out = []
    for step in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F):
        x, done, total, used = mixed(h ^ np.uint64(step)), 1, None, 0
        power = step
        while True:  # by doubling: x names ``done`` words, total the first ``used``
            if window & done:
                total = x.copy() if total is None else (
                    x[:len(x) - used] * np.uint64(pow(step, used, 1 << 64)) + total[done:][:len(x) - used])
                used += done
            if used == window:
                break
            x, power, done = x[:len(x) - done] * np.uint64(power) + x[done:], power * power % (1 << 64), done * 2
        out.append(mixed(total))
    return out[0], (out[1] >> np.uint64(33)).astype(np.int64)


class Words:
    """The words of some documents, one after the other, as hashes."""

    def __init__(self, keys: list, texts: list[str], hashes: WordHashes, window: int):
        if len(hashes) > REMEMBERED:
            hashes.clear()
        self.split = [x.encode().split() for x in texts]
        self.counts = np.array([len(w) for w in self.split], np.int64)
        total = int(self.counts.sum())
        self.h = np.fromiter((hashes[w] for s in self.split for w in s), np.uint64, total)
        self.doc = np.repeat(np.arange(len(keys)), self.counts)
        self.first = np.cumsum(self.counts) - self.counts
        known = np.array([k is not None for k in keys], bool)
        open_ = np.repeat(known & (self.counts >= window), self.counts)
        end = np.repeat(self.first + self.counts, self.counts)
        self.starts = np.flatnonzero(open_ & (np.arange(total) + window <= end))
        self.keys = np.array([k or 0 for k in keys], np.int64)


ROWS = "kind int, name long, doc long, n long, sha string"
DOC, SHARED, ENTRY = 0, 1, 2


def _phrase_rows(docs: DataFrame, window: int) -> DataFrame:
    """Of each slice of documents: words and digest of each; of each phrase one entry with the number of places
    where it occurs; and (phrase, doc) of those that a slice already has twice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for part in spans_of_rows(batch, "text"):
                keys = part.column(0).to_pylist()
                w = Words(keys, [x or "" for x in part.column(1).to_pylist()], hashes, window)
                none = [None] * len(keys)
                yield arrow(ROWS, kind=[DOC] * len(keys), name=none, doc=keys, n=w.counts,
                            sha=[hashlib.sha256(b" ".join(s)).hexdigest() for s in w.split])
                if not len(w.starts):
                    continue
                name, at = phrases(w.h, w.doc, w.starts, window)
                places, pick = np.unique(at, return_index=True)
                name, doc = name[pick], w.keys[w.doc[places]]
                order = np.lexsort((doc, name))
                name, doc = name[order], doc[order]
                new = np.r_[True, name[1:] != name[:-1]]
                count = np.diff(np.r_[np.flatnonzero(new), len(name)])
                yield arrow(ROWS, kind=np.full(new.sum(), ENTRY), name=name[new].view(np.int64), doc=doc[new],
                            n=count, sha=[None] * int(new.sum()))
                twice = np.repeat(count > 1, count) & (new | np.r_[True, doc[1:] != doc[:-1]])
                if twice.any():
                    yield arrow(ROWS, kind=np.full(twice.sum(), SHARED), name=name[twice].view(np.int64),
                                doc=doc[twice], n=np.zeros(twice.sum(), np.int64), sha=[None] * int(twice.sum()))

    return docs.mapInArrow(handing_back(run), ROWS)


def _shared_phrases(rows: DataFrame) -> DataFrame:
    """One exchange of the entries by name; those whose name has another entry come out as shared.

    Streams over sorted rows and holds one row, however many share a name.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # name, doc, n of the last entry, and whether it was seen to be shared
        for batch in batches:
            kind = batch.column(0).to_numpy(zero_copy_only=False)
            if (kind != ENTRY).any():
                yield batch.filter(pa.array(kind != ENTRY))
            batch = batch.filter(pa.array(kind == ENTRY))
            if not batch.num_rows:
                continue
            name, doc, n = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (1, 2, 3))
            if last is not None:
                name, doc, n = np.r_[last[0], name], np.r_[last[1], doc], np.r_[last[2], n]
            same = name[1:] == name[:-1]
            shared = (np.r_[False, same] | np.r_[same, False]) & (n == 1)
            # the last row waits for its successor; if it is told already, it counts as told (n = 2)
            told = shared[-1]
            last = (name[-1], doc[-1], 2 if told else n[-1])
            if shared.any():
                k = int(shared.sum())
                yield arrow(ROWS, kind=np.full(k, SHARED), name=name[shared], doc=doc[shared], n=np.zeros(k, np.int64),
                            sha=[None] * k)

    to = F.when(F.col("kind") == ENTRY, F.col("name")).otherwise(F.xxhash64("doc", "kind"))
    return rows.repartition(to).sortWithinPartitions("kind", "name", "doc").mapInArrow(handing_back(run), ROWS)


WINDOWS = "name long, more int, doc long, tag long, start int"
PLACES = "doc long, tag long, start int"


def row_tag(words: list[bytes]) -> int:
    """What tells rows of one key apart: a hash of their words."""
    return xxhash.xxh3_64_intdigest(b" ".join(words)) >> 1


def _windows(docs: DataFrame, window: int) -> DataFrame:
    """Windows of (doc, text, names, many) whose phrase is among ``names``: of each slice the first of equal ones, and the
    later ones, which have no name and -1 - start.  Only rows of a key with ``many`` texts have a tag."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for part in spans_of_rows(batch, "text"):
                w = Words(part.column(0).to_pylist(), [x or "" for x in part.column(1).to_pylist()], hashes, window)
                if not len(w.starts):
                    continue
                shared = part.column(2)
                name, _ = phrases(w.h, w.doc, w.starts, window)
                # (row, phrase) pairs that are shared, by one sorted search for all rows
                own = np.repeat(np.arange(len(shared)), np.diff(shared.offsets.to_numpy()))
                flat = shared.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                mark = mixed(flat.view(np.uint64) + own.astype(np.uint64) * STEP)
                at = w.starts[np.isin(mixed(name + w.doc[w.starts].astype(np.uint64) * STEP), mark)]
                if not len(at):
                    continue
                tags = np.array([row_tag(x) if many else 0 for x, many in zip(w.split, part.column(3).to_pylist())], np.int64)
                one, two = (x[at] for x in window_names(w.h, window))
                doc, tag, start = w.keys[w.doc[at]], tags[w.doc[at]], at - w.first[w.doc[at]]
                order = np.lexsort((tag, start, doc, two, one))
                one, two, doc, tag, start = (x[order] for x in (one.view(np.int64), two, doc, tag, start))
                new, later = _first_and_later(one, two, doc, tag, start)
                yield arrow(WINDOWS, name=one[new], more=two[new], doc=doc[new], tag=tag[new], start=start[new])
                if later.any():
                    none = [None] * int(later.sum())
                    yield arrow(WINDOWS, name=none, more=none, doc=doc[later], tag=tag[later], start=-1 - start[later])

    return docs.mapInArrow(handing_back(run), WINDOWS)


def _first_and_later(name, more, doc, tag, start):
    """Of windows sorted by names and place: the first of each name, and those that lie elsewhere than the first.

    Equal rows of one key are one place.
    """
    new = np.r_[True, (name[1:] != name[:-1]) | (more[1:] != more[:-1])]
    lead = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    return new, ~new & ((doc != doc[lead]) | (start != start[lead]) | (tag != tag[lead]))


def _later_windows(rows: DataFrame) -> DataFrame:
    """Place of every window with an equal one before it; streams like _shared_phrases."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # names and place of the first window of the last group
        for batch in batches:
            told = batch.filter(pa.compute.is_null(batch.column(0)))
            if told.num_rows:
                doc, tag, start = (told.column(i).to_numpy() for i in (2, 3, 4))
                yield arrow(PLACES, doc=doc, tag=tag, start=-1 - start)
            columns = [c.to_numpy() for c in batch.filter(pa.compute.is_valid(batch.column(0))).columns]
            if not len(columns[0]):
                continue
            if last is not None:
                columns = [np.r_[v, x] for v, x in zip(last, columns)]
            new, later = _first_and_later(*columns)
            k = len(new) - 1 - int(np.argmax(new[::-1]))
            last = [x[k] for x in columns]
            if later.any():
                yield arrow(PLACES, **{n: x[later] for n, x in zip(("doc", "tag", "start"), columns[2:])})

    to = F.coalesce("name", F.xxhash64("doc", "start"))
    ordered = rows.repartition(to).sortWithinPartitions("name", "more", "doc", "start", "tag")
    return ordered.mapInArrow(handing_back(run), PLACES)


KEPT = "doc long, sha string, n_removed long, kept_sha string"


def _kept(docs: DataFrame, window: int) -> DataFrame:
    """Of (doc, text, many, starts, tags): digest of the words, number of those that a window from ``starts``
    covers, digest of the others; starts of other rows of the key have other tags."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in spans_of_rows(batch, "text"):
                out = ([], [], [], [])
                for doc, x, many, starts, tags in zip(part.column(0).to_pylist(), part.column(1).to_pylist(),
                                                      part.column(2).to_pylist(), part.column(3), part.column(4)):
                    words = (x or "").encode().split()
                    edge = np.zeros(len(words) + 1, np.int64)
                    at = starts.values.to_numpy(zero_copy_only=False)
                    at = at[tags.values.to_numpy(zero_copy_only=False) == (row_tag(words) if many else 0)]
                    np.add.at(edge, at, 1)
                    np.add.at(edge, at + window, -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    kept = [w for w, g in zip(words, gone.tolist()) if not g]
                    for column, v in zip(out, (doc, hashlib.sha256(b" ".join(words)).hexdigest(), int(gone.sum()),
                                               hashlib.sha256(b" ".join(kept)).hexdigest())):
                        column.append(v)
                yield arrow(KEPT, doc=out[0], sha=out[1], n_removed=out[2], kept_sha=out[3])

    return docs.mapInArrow(handing_back(run), KEPT)


def drop_repeats(docs: DataFrame, window: int = 20, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256 after removing each word that lies in a window
    whose words also occur as a window that begins earlier (smaller key, or same key and earlier word).

    Every window of the corpus is judged, on the input as it was.  Texts move once, by key, and those
    with repeats once more; phrases and windows move as hashes, one row for each slice of documents
    that has them, so no hot passage meets in one task.  A null or empty text has no words.  A row with a null
    key has no place in the order: it is kept whole and not compared.  Rows of one key and different words are
    ordered by start, then by a hash of their words; rows of one key and equal words are one place, whose windows
    repeat nothing in one another.  No rows give none.
    """
    if window < 20:
        raise ValueError("two rounds leave four symbols only of windows of 20 words or more")
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    named = stored(_shared_phrases(_phrase_rows(rows, window)), "phrases")
    whole = named.where(F.col("kind") == DOC).select("doc", F.col("n").alias("n_words"), "sha")
    # a row's phrases are no more than its words
    shared = (named.where("doc IS NOT NULL").groupBy("doc").agg(
        F.collect_list(F.when(F.col("kind") == SHARED, F.col("name"))).alias("names"), (F.min("sha") < F.max("sha")).alias("many"))
        .where(F.size("names") > 0))
    some = stored(rows.join(shared.hint("merge"), "doc").select("doc", "text", "names", "many"), "repeat-texts")
    later = stored(_later_windows(_windows(some, window)), "later-windows")
    starts = later.groupBy("doc").agg(F.collect_set(F.struct("start", "tag")).alias("at"))
    starts = starts.select("doc", F.col("at.start").alias("starts"), F.col("at.tag").alias("tags"))
    kept = _kept(some.select("doc", "text", "many").join(starts.hint("merge"), "doc").select("doc", "text", "many", "starts", "tags"), window)
    kept = kept.dropDuplicates(["doc", "sha"])  # equal rows of one key
    return (whole.join(kept, ["doc", "sha"], "left")
            .select(F.col("doc").alias("doc_id"), "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
                    F.coalesce("kept_sha", "sha").alias("kept_sha256")))
