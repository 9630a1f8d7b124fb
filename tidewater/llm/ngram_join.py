"""N-gram Jaccard self-join by set relations.

A document's shingle set is kept in one global order (that of the shingles'
hashes).  Its positions are cut in blocks by hash range; index lists hold the
sets that have one block in common, by position and content.  Two sets at the
threshold differ in at most k shingles, so of k + 1 + s blocks they share s + 1
at least: a set skips its s least telling blocks (those of fewest shingles) and all lists of
other positions, and still meets every partner.  Blocks without shingles say nothing and make no lists.  Sets that
share nothing but such blocks are met by their first k + 1 shingles in the global order, one of which they must have in common.

The sets of a list are then answered from one of them, its leader: each is
compared with the leader; who links with it shares the leader's component and
needs no other pair of the list.  For lists that this leaves in several components, the
other answers follow from the differences D(x) from the leader: two
sets x and y differ in exactly the shingles in which D(x) and D(y) differ.  Members whose sketches (counts of
shingles by hash range) differ from those of all members of other components by more than linked sets can are left out before.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import arrow, handing_back, release, spans_of_rows, stored
from tidewater.llm.components import components

#: Distinct words whose hashes a worker remembers before it starts anew.
REMEMBERED = 100_000


@dataclass(frozen=True)
class Threshold:
    """Link if den * intersection >= num * union."""

    num: int = 90
    den: int = 100

    def differ(self, total):
        """Most shingles in which two linked sets of ``total`` shingles together differ."""
        return total * (self.den - self.num) // (self.den + self.num)

    def linked(self, inter, total):
        return self.den * inter >= self.num * (total - inter)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed mixing of 64-bit words (wrapping arithmetic)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str, n: int, hashes: WordHashes) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct ``n``-word shingles, A-Z in lower case.

    With fewer words the whole sequence is one shingle; without words the set is empty.
    """
    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(hashes) > REMEMBERED:
        hashes.clear()
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(n, len(h))
    out = np.full(len(h) - width + 1, width, np.uint64)
    for k in range(width):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[k:len(h) - width + 1 + k])
    return np.unique(out)


def bands(threshold: Threshold, most: int) -> list[tuple[int, int]]:
    """Ranges of set sizes; partners lie in the same range or in neighbouring ones."""
    out, low = [], 1
    while low <= most:
        high = max(low, low * threshold.den // threshold.num)
        out.append((low, high))
        low = high + 1
    return out


def block_keys(s: np.ndarray, band: int, high: int, threshold: Threshold) -> np.ndarray:
    """Index keys of a set for pairs whose larger set lies in ``band`` (sizes up to ``high``)."""
    k = threshold.differ(2 * high)
    skipped = (k + 1) // 8 if k else 0
    m = k + 1 + skipped
    where = ((s >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
    edges = np.searchsorted(where, np.arange(m + 1, dtype=np.uint64))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(s), dtype=np.uint64)])
    counts = np.diff(edges)
    keys = mixed(mixed(sums[edges[1:]] - sums[edges[:-1]]) + np.arange(m, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                 + np.uint64(band << 40))
    order = np.lexsort((keys, counts))[skipped:]  # the same order of blocks for every set: fewest shingles first, then by key
    full = counts[order] > 0
    empty = keys[order[~full]]
    if not len(empty):
        return keys[order]
    # under each empty block that is not skipped: two sets differ in k shingles at most, so of the first k + 1 they share one
    first = mixed(s[:k + 1] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
    return np.concatenate([keys[order[full]], mixed(first[None, :] ^ empty[:, None]).ravel()])


ROWS = "kind int, key long, doc long, lead long, n long"
SIZE, COPY, STAR, ENTRY, FIRSTS = 0, 1, 2, 3, 4


def _index_rows(docs: DataFrame, n: int, threshold: Threshold, key: str, text: str) -> DataFrame:
    """Of each slice of documents: their set sizes, copies of a set (with the first), and for each
    block the first set that has it (an entry for the index lists) and the others (with the first)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, ranges = WordHashes(), bands(threshold, 64)
        for batch in batches:
            for part in spans_of_rows(batch, "text"):
                sizes, copies, first, keys, owners = [], [], {}, [], []
                for doc, x in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    s = shingle_set(x or "", n, hashes)
                    sizes.append((doc, len(s)))
                    if doc is None or not len(s):
                        continue
                    seen = first.setdefault(s.tobytes() if len(s) < 4 else xxhash.xxh3_128_digest(s.tobytes()), doc)
                    if seen != doc:
                        copies.append((doc, seen))
                        continue
                    if ranges[-1][1] < 2 * len(s) + 2:
                        ranges = bands(threshold, 4 * len(s) + 4)
                    own = next(i for i, (_, high) in enumerate(ranges) if len(s) <= high)
                    for band in (own, own + 1):
                        keys.append(block_keys(s, band, ranges[band][1], threshold))
                        owners.append(np.full(len(keys[-1]), doc, np.int64))
                kind = [SIZE] * len(sizes) + [COPY] * len(copies)
                yield arrow(ROWS, kind=kind, key=[None] * len(kind), doc=[d for d, _ in sizes + copies],
                            lead=[None] * len(sizes) + [b for _, b in copies], n=[c for _, c in sizes] + [None] * len(copies))
                if keys:
                    k, d = np.concatenate(keys), np.concatenate(owners)
                    order = np.lexsort((d, k))
                    k, d = k[order], d[order]
                    new = np.r_[True, k[1:] != k[:-1]]
                    lead = d[np.maximum.accumulate(np.where(new, np.arange(len(k)), 0))]
                    first = lead == d  # an entry needs no lead: rows that move are short
                    yield arrow(ROWS, kind=np.where(first, ENTRY, STAR).astype(np.int32), key=k.view(np.int64), doc=d,
                                lead=pa.array(lead, mask=first), n=pa.nulls(len(k), pa.int64()))

    return docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).mapInArrow(handing_back(run), ROWS)


def _lists(rows: DataFrame) -> DataFrame:
    """One exchange of the entries by key; of each list of two or more, the later sets with the first as leader.

    Streams over the sorted rows and holds nothing but the last key, however long a list.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, leader = None, None
        for batch in batches:
            kind, key, doc = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 2))
            other = kind != ENTRY
            if other.any():
                yield batch.filter(pa.array(other))
            at = np.flatnonzero(~other)
            if not len(at):
                continue
            k, d = key[at].astype(np.int64), doc[at].astype(np.int64)
            new = np.r_[k[0] != last if last is not None else True, k[1:] != k[:-1]]
            group = np.maximum.accumulate(np.where(new, np.arange(len(k)), -1))
            lead = np.where(group < 0, leader if leader is not None else 0, d[np.maximum(group, 0)])
            last, leader = k[-1], lead[-1]
            late = ~new & (lead != d)
            if late.any():
                yield arrow(ROWS, kind=np.full(late.sum(), FIRSTS, np.int32), key=k[late], doc=d[late], lead=lead[late],
                            n=pa.nulls(int(late.sum()), pa.int64()))

    # rows that are no entries go by document and kind, so that they gather nowhere
    to = F.when(F.col("kind") == ENTRY, F.col("key")).otherwise(F.xxhash64("doc", "kind"))
    return rows.repartition(to).sortWithinPartitions("kind", "key", "doc").mapInArrow(handing_back(run), ROWS)


def _sets(docs: DataFrame, n: int, key: str, text: str, extra: str = "") -> DataFrame:
    """(doc, s: the sorted shingle hashes as bytes), further columns ``extra`` passed on."""
    names = [x.split()[0] for x in extra.split(", ")] if extra else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for part in spans_of_rows(batch, "text"):
                s = [shingle_set(x or "", n, hashes).tobytes() for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(s, pa.binary()), *(part.column(x) for x in names)], ["doc", "s", *names])

    rows = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"), *names)
    return rows.mapInArrow(handing_back(run), "doc long, s binary" + (", " + extra if extra else ""))


PAIRS = "doc long, lead long, n_doc long, n_lead long, gap long, differ binary"


def _compare(pairs: DataFrame, whole: bool = False) -> DataFrame:
    """Rows (doc, s, lead, t) to the sizes of both sets and how many shingles they differ in; with ``whole`` also which."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = ([], [], [], [], [], [])
            for doc, s, lead, t in zip(*(batch.column(x) for x in ("doc", "s", "lead", "t"))):
                a, b = (np.frombuffer(x.as_buffer(), np.uint64) for x in (s, t))
                both = np.concatenate([a, b])
                both.sort(kind="stable")
                same = np.r_[False, both[1:] == both[:-1]]
                differ = both[~(same | np.r_[same[1:], False])]
                for column, v in zip(out, (doc.as_py(), lead.as_py(), len(a), len(b), len(differ), differ.tobytes() if whole else None)):
                    column.append(v)
            yield arrow(PAIRS, **dict(zip(("doc", "lead", "n_doc", "n_lead", "gap", "differ"), out)))

    return pairs.select("doc", "s", "lead", "t").mapInArrow(handing_back(run), PAIRS)


def _compare_by_id(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(doc, lead) pairs with their differences; ``sets`` is read again for either side."""
    right = sets.where("leads").select(F.col("doc").alias("lead"), F.col("s").alias("t"))
    return _compare(pairs.join(sets.select("doc", "s").hint("merge"), "doc").join(right.hint("merge"), "lead"), whole=True)


def _labelled(star: DataFrame, comp: DataFrame) -> DataFrame:
    """``star`` with the components of doc and lead (a node without links is its own)."""
    for side in ("doc", "lead"):
        c = comp.select(F.col("node").alias(side), F.col("component").alias(f"c_{side}"))
        star = star.join(c, side, "left").withColumn(f"c_{side}", F.coalesce(f"c_{side}", side))
    return star


#: Bits of the filter over the documents that are asked for: 8 MB, whatever their number.
FILTER_BITS = 1 << 26


def _filtered(rows: DataFrame, asked: DataFrame) -> DataFrame:
    """``rows`` without most of those whose ``doc`` is not in ``asked``, told by a bitmap of fixed size before they move.

    It drops no row that is asked for; the more are asked for, the more others stay.
    """
    place = F.pmod(F.xxhash64("doc"), F.lit(FILTER_BITS))
    bits = asked.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("b")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits")).collect()  # FILTER_BITS in all at most
    table = np.zeros(FILTER_BITS // 8 + 4096, np.uint8)
    for r in bits:
        table[r["b"] * 4096:(r["b"] + 1) * 4096] = np.frombuffer(r["bits"], np.uint8)
    whole = rows.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf("boolean")
    def may(p: pd.Series) -> pd.Series:
        # positions are counted as the aggregate does: buckets from 1, bits from 0
        p = p.to_numpy()
        bucket, bit = np.where(p > 0, 1 + (p - 1) // 32768, 0), np.where(p > 0, (p - 1) % 32768, 0)
        return pd.Series((whole.value[bucket * 4096 + bit // 8] >> (bit % 8)) & 1 == 1)

    return rows.where(F.col("doc").isNotNull()).where(may(place))


LINKS = "doc long, lead long"
#: Members of a leader that are compared with each other at a time, and bytes of their differences.
TOGETHER, TOGETHER_BYTES = 1024, 4 << 20


def _linked(differ: list[np.ndarray], size: np.ndarray, threshold: Threshold) -> np.ndarray:
    """Which sets link, by their differences from one set (square, boolean)."""
    n = len(differ)
    own = np.repeat(np.arange(n), [len(d) for d in differ])
    _, token, count = np.unique(np.concatenate(differ), return_inverse=True, return_counts=True)
    both = np.zeros((n, n), np.float32)
    order = np.argsort(token, kind="stable")
    own, start = own[order], np.cumsum(count) - count
    for c in range(2, 9):  # shingles that few sets have: their pairs
        at = start[count == c]
        if len(at):
            who = own[at[:, None] + np.arange(c)]
            i, j = np.triu_indices(c, 1)
            np.add.at(both, (who[:, i].ravel(), who[:, j].ravel()), 1)
    both += both.T
    many = np.flatnonzero(count > 8)
    for some in np.array_split(many, len(many) // 2048 + 1):  # the others: a product of 0/1 matrices
        x = np.zeros((n, len(some)), np.float32)
        for k, t in enumerate(some):
            x[own[start[t]:start[t] + count[t]], k] = 1
        both += x @ x.T
    length = np.array([len(d) for d in differ], np.int64)
    gap = length[:, None] + length[None, :] - 2 * both.astype(np.int64)
    total = size[:, None] + size[None, :]
    return threshold.den * (total - gap) >= threshold.num * (total + gap)


def _member_links(members: DataFrame, threshold: Threshold) -> DataFrame:
    """members: lead, doc, comp, size, differ (from the lead; the lead itself has none).

    Links between members of different components, as few as connect those
    components.  Members of one lead are dealt into parts of about TOGETHER, fewer where their differences are
    long, and each two parts meet in a task, so that none holds more than two parts however many share a lead.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(rows: list[tuple]):
            part, doc, comp, size, differ = zip(*rows)
            part, comp = np.array(part), np.array(comp)
            found = _linked([np.frombuffer(d, np.uint64) for d in differ], np.array(size, np.int64), threshold)
            found &= comp[:, None] != comp[None, :]
            if part.min() != part.max():  # two parts: pairs within one are met elsewhere
                found &= part[:, None] != part[None, :]
            root = {c: c for c in set(comp.tolist())}

            def top(c):
                while root[c] != c:
                    root[c] = c = root[root[c]]
                return c

            out = []
            for i, j in zip(*(x.tolist() for x in np.nonzero(np.triu(found, 1)))):
                a, b = top(int(comp[i])), top(int(comp[j]))
                if a != b:
                    root[a] = b
                    out.append((doc[i], doc[j]))
            if out:
                yield arrow(LINKS, doc=[a for a, _ in out], lead=[b for _, b in out])

        last, held = None, []
        for batch in batches:
            for lead, i, j, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if (lead, i, j) != last and held:
                    yield from links(held)
                    held = []
                last = (lead, i, j)
                held.append(tuple(row))
        if held:
            yield from links(held)

    rows = _dealt(members, TOGETHER, TOGETHER_BYTES, "differ").select("lead", "i", "j", "part", "doc", "comp", "size", "differ")
    return rows.repartition("lead", "i", "j").sortWithinPartitions("lead", "i", "j").mapInArrow(handing_back(run), LINKS)


def _dealt(members: DataFrame, together: int, most_bytes: int, column: str) -> DataFrame:
    """Members of each lead in parts of about ``together`` rows or ``most_bytes`` of ``column``, a copy for each two parts (i, j)
    that meet: part 0 with part 0 is met once, part 0 with part 1 has the rows of both."""
    count = members.groupBy("lead").agg(F.count("*").alias("n"), F.sum(F.length(column)).alias("bytes"))
    parts = F.greatest(F.ceil(F.col("n") / together), F.ceil(F.col("bytes") / most_bytes)).cast("int")
    return (members.join(count, "lead").withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("doc"), F.col("parts")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .withColumns({"i": F.least("part", "other"), "j": F.greatest("part", "other")}))


#: Ranges of hashes whose shingles a sketch counts, a byte each.
SKETCH = 512
SKETCHES = "doc long, size long, sketch binary"


def sketch_of(s: np.ndarray) -> np.ndarray:
    """How many shingles of a set fall into each range of hashes, 255 at most."""
    return np.minimum(np.bincount((s >> np.uint64(55)).astype(np.int64), minlength=SKETCH), 255).astype(np.uint8)


def _sketches(sets: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column(1)]
            yield arrow(SKETCHES, doc=batch.column(0), size=[len(x) for x in found], sketch=[sketch_of(x).tobytes() for x in found])

    return sets.select("doc", "s").mapInArrow(handing_back(run), SKETCHES)


def may_link(sketch: np.ndarray, size: np.ndarray, comp: np.ndarray, threshold: Threshold) -> np.ndarray:
    """Which of some sets may link with one of another component: sets differ in as many shingles at least as the counts
    of their sketches do, so no link is ruled out."""
    out = np.zeros(len(size), bool)
    for at in range(0, len(size), 256):
        a = slice(at, at + 256)
        gap = np.array([np.abs(x - sketch).sum(1, dtype=np.int64) for x in sketch[a]])
        total = size[a, None] + size[None, :]
        ok = (threshold.den * (total - gap) >= threshold.num * (total + gap)) & (comp[a, None] != comp[None, :])
        out[a] |= ok.any(1)
        out |= ok.any(0)
    return out


PROMISING = "lead long, doc long"


def _promising(members: DataFrame, threshold: Threshold) -> DataFrame:
    """members: lead, doc, comp, size, sketch.  Those that may link with another member of the lead, of another component."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(lead: int, rows: list[tuple]):
            doc, comp, size, sketch = zip(*rows)
            sketch = np.array([np.frombuffer(x, np.uint8) for x in sketch], np.int16)
            some = np.flatnonzero(may_link(sketch, np.array(size, np.int64), np.array(comp, np.int64), threshold))
            if len(some):
                yield arrow(PROMISING, lead=[lead] * len(some), doc=[doc[k] for k in some])

        last, held = None, []
        for batch in batches:
            for lead, i, j, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if (lead, i, j) != last and held:
                    yield from found(last[0], held)
                    held = []
                last = (lead, i, j)
                held.append(tuple(row))
        if held:
            yield from found(last[0], held)

    rows = _dealt(members, TOGETHER, 1 << 30, "sketch").select("lead", "i", "j", "doc", "comp", "size", "sketch")
    rows = rows.repartition("lead", "i", "j").sortWithinPartitions("lead", "i", "j")
    return rows.mapInArrow(handing_back(run), PROMISING).distinct()


def jaccard_components(docs: DataFrame, n: int = 5, threshold: Threshold = Threshold(80, 100), key: str = "doc_id",
                       text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles and component_id, the smallest doc_id reachable by links.

    No link between documents is lost and no copies are expanded into pairs.  Joins
    with texts and sets ask for a sort-merge join: their other side grows with the corpus,
    so the plan is that of a large one at every size.  A
    null or empty text has an empty set and links with nothing; a row with a
    null key has a null component; rows of equal key are one node, which links
    as any of them does.  No rows give none.
    """
    rows = stored(_lists(_index_rows(docs, n, threshold, key, text)), "jaccard-lists")
    small = stored(rows.where(F.col("kind").isin(SIZE, COPY)).select("kind", "doc", "lead", "n"), "jaccard-sizes")
    sizes = small.where(F.col("kind") == SIZE).select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"))
    copies = small.where(F.col("kind") == COPY).select("doc", "lead")
    star = rows.where(F.col("kind") == STAR).select("key", "doc", "lead")
    firsts = rows.where(F.col("kind") == FIRSTS).select("key", "doc", "lead")

    # 1: each set with the leader that it meets in most lists; the first of a slice has its list's leader
    above = firsts.select("key", F.col("doc").alias("lead"), F.col("lead").alias("above"))
    star = star.join(above, ["key", "lead"], "left").select("key", "doc", F.coalesce("above", "lead").alias("lead"))
    met = star.union(firsts).where("doc != lead").groupBy("doc", "lead").agg(F.count("*").alias("lists"))
    met = stored(met, "jaccard-met")
    release(rows)
    best = met.groupBy("doc").agg(F.max(F.struct("lists", (-F.col("lead")).alias("lead"))).alias("m")).select(
        "doc", (-F.col("m.lead")).alias("lead"))
    leads = met.select(F.col("lead").alias("doc")).distinct().withColumn("leads", F.lit(True))
    asked = stored(best.join(leads, "doc", "full").withColumn("leads", F.coalesce("leads", F.lit(False))), "jaccard-asked")
    texts = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    texts = _filtered(texts, asked).join(asked.hint("merge"), "doc")
    sets = stored(_sets(texts, n, "doc", "text", "lead long, leads boolean"), "jaccard-sets")
    right = sets.where("leads").select(F.col("doc").alias("lead"), F.col("s").alias("t"))
    done = stored(_compare(sets.where("lead is not null").select("doc", "s", "lead").join(right.hint("merge"), "lead")), "jaccard-pairs")

    total, gap = F.col("n_doc") + F.col("n_lead"), F.col("gap")
    linked = done.where(threshold.den * (total - gap) >= threshold.num * (total + gap)).select("doc", "lead")
    edges = copies.union(linked)
    comp = components(edges, "doc", "lead")

    # 2: leaders whose lists this leaves in several components, and of their members those that may link with one another
    split = stored(_labelled(met, comp).where("c_doc != c_lead").select("lead").distinct(), "jaccard-open")
    if not split.isEmpty():
        label = comp.select(F.col("node").alias("doc"), F.col("component").alias("comp"))
        own = split.select(F.col("lead").alias("doc"), "lead")
        asked = met.join(split, "lead", "left_semi").select("doc", "lead").union(own)
        members = asked.join(_sketches(sets).hint("merge"), "doc").join(label, "doc", "left").withColumn("comp", F.coalesce("comp", "doc"))
        some = stored(_promising(members, threshold), "jaccard-promising")
        few = stored(_filtered(sets, some.select("doc").union(some.select("lead"))), "jaccard-few-sets")
        compared = stored(_compare_by_id(some.where("doc != lead").select("doc", "lead"), few), "jaccard-differences")
        own = _sketches(few.join(some.where("doc = lead").select("doc").hint("merge"), "doc", "left_semi"))
        own = own.select(F.col("doc").alias("lead"), "doc", "size", F.lit(b"").alias("differ"))
        members = compared.select("lead", "doc", F.col("n_doc").alias("size"), "differ").union(own)
        members = members.join(label, "doc", "left").withColumn("comp", F.coalesce("comp", "doc"))
        edges = edges.union(stored(_member_links(members, threshold), "jaccard-links"))
        release(compared, few)
        comp = components(edges, "doc", "lead")
    release(sets)

    return (sizes.join(comp.withColumnRenamed("node", "doc_id"), "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")))
