"""Alignment of two tokenizers by the byte offsets at which their tokens end.

Both split the same bytes, so a document is two ascending lists of ends.  The
shorter list drives: for each of its ends an exponential search from the last
place, then a binary search, finds its rank in the longer one.  Ends in both lists cut
the tokens into groups; a token of the shorter list overlaps the tokens of the longer one from the
rank of its start to that of its end.

A link is an A and a B token that end together.  How often two ids are linked is counted over
the corpus: each chunk of documents sends the distinct pairs of its links once, and gets their totals
back for its documents' sums.
"""

from __future__ import annotations

import hashlib
import json
import os
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import handing_back, spans_of_rows, stored
from tidewater.llm.token_files import byte_letters

#: Links of a chunk at least before its pairs are sent.
CHUNK_LINKS = 2_000_000
#: Below this character the byte-level splitters of the two libraries agree (tests/llm goes through all of them).
AGREED = "ɐ"


def ranks_in(short: list[int], long: list[int]) -> list[int]:
    """For each of ``short`` the number of smaller ones in ``long``; both ascend and ``long`` ends with the greatest."""
    out, at, last = [], 0, len(long) - 1
    for x in short:
        if long[at] < x:
            at += 1
            if long[at] < x:
                low, step = at, 1
                while at + step < last and long[at + step] < x:
                    low, step = at + step, 2 * step
                at = bisect_left(long, x, low + 1, min(at + step, last) + 1)
        out.append(at)
    return out


@dataclass
class Alignment:
    """Ids of both tokenizers; index in either of the last token of each group; ranks of the shorter
    list's ends in the longer one (``by_a``: the shorter list is A)."""

    a: np.ndarray
    b: np.ndarray
    cut_a: np.ndarray
    cut_b: np.ndarray
    by_a: bool
    ranks: np.ndarray

    def overlaps(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each token of the shorter list the first and last token of the longer one that share a byte with it."""
        common = np.zeros(len(self.ranks), bool)
        common[self.cut_a if self.by_a else self.cut_b] = True
        before = np.r_[0, (self.ranks + common)[:-1]]
        return before, self.ranks

    def groups(self, a_names: list[str], b_names: list[str]) -> str:
        """``a1,a2|b1;a3|b2,b3``"""
        a = [a_names[i] for i in self.a.tolist()]
        b = [b_names[i] for i in self.b.tolist()]
        out, i, j = [], 0, 0
        for x, y in zip(self.cut_a.tolist(), self.cut_b.tolist()):
            if x == i and y == j:
                out.append(f"{a[i]}|{b[j]}")
            else:
                out.append(",".join(a[i:x + 1]) + "|" + ",".join(b[j:y + 1]))
            i, j = x + 1, y + 1
        return ";".join(out)


def align(a: np.ndarray, a_sizes: np.ndarray, b: np.ndarray, b_sizes: np.ndarray) -> Alignment:
    """Alignment of two tokenizations of the same bytes (one byte at least), given each token's bytes."""
    ends_a, ends_b = np.cumsum(a_sizes), np.cumsum(b_sizes)
    by_a = len(ends_a) <= len(ends_b)
    short, long = (ends_a, ends_b) if by_a else (ends_b, ends_a)
    ranks = np.array(ranks_in(short.tolist(), long.tolist()), np.int64)
    both = np.flatnonzero(long[ranks] == short)
    cut_a, cut_b = (both, ranks[both]) if by_a else (ranks[both], both)
    return Alignment(a, b, cut_a, cut_b, by_a, ranks)


class ByteLevel:
    """Tokenizer A: a byte-level BPE of the tokenizers library."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True  # their strings in a text are ordinary text
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte = {x: b for b, x in enumerate(byte_letters())}
        special = {x["id"] for x in spec["added_tokens"]}
        vocabulary = {k: i for k, i in spec["model"]["vocab"].items() if i not in special}
        self.bytes = [b""] * (max([*vocabulary.values(), *special], default=-1) + 1)
        for k, i in vocabulary.items():
            self.bytes[i] = bytes(byte[c] for c in k)
        merged = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in spec["model"]["merges"]]
        split = spec["pre_tokenizer"]
        # where ids ascend with the merges, they are the ranks of the same merges for the quicker library
        self.quick = None
        if (merged == sorted(set(merged)) and split["type"] == "ByteLevel" and split["use_regex"]
                and not split["add_prefix_space"] and spec["normalizer"] is None):
            self.quick = tiktoken.Encoding("ranks", pat_str=PATTERN, special_tokens={},
                                           mergeable_ranks={self.bytes[i]: i for i in vocabulary.values()})
        self.sizes = np.array([len(x) for x in self.bytes], np.int64)

    def encode(self, texts: list[str]) -> list[list[int]]:
        out: list = [None] * len(texts)
        other = []
        for k, x in enumerate(texts):
            if self.quick and (x.isascii() or max(x) < AGREED):
                out[k] = self.quick.encode_ordinary(x)
            else:
                other.append(k)
        for k, e in zip(other, self.library.encode_batch([texts[k] for k in other], add_special_tokens=False)):
            out[k] = e.ids
        return out


#: Fixed value: the public pattern of byte-level splitters.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Pieces:
    """Tokenizer B: a sentencepiece model with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.library.get_piece_size()
        self.bytes = [bytes([int(self.library.id_to_piece(i)[1:-1], 16)]) if self.library.is_byte(i)
                      else self.library.id_to_piece(i).replace("▁", " ").encode() for i in range(n)]
        self.sizes = np.array([len(x) for x in self.bytes], np.int64)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.library.encode(texts, num_threads=1)


class Aligner:
    """Alignments of whole texts."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a, self.b = ByteLevel(a_path), Pieces(b_path)

    def align(self, texts: list[str]) -> list[Alignment | None]:
        """None for an empty text, and where the tokens of A or B do not spell space + text."""
        out: list[Alignment | None] = [None] * len(texts)
        some = [k for k, x in enumerate(texts) if x]
        spaced = [" " + texts[k] for k in some]
        for k, x, a, b in zip(some, spaced, self.a.encode(spaced), self.b.encode([texts[k] for k in some])):
            want = x.encode()
            if (b"".join(map(self.a.bytes.__getitem__, a)) == want
                    and b"".join(map(self.b.bytes.__getitem__, b)) == want):
                a, b = np.array(a, np.int64), np.array(b, np.int64)
                out[k] = align(a, self.a.sizes[a], b, self.b.sizes[b])
        return out


ALIGNED = ("doc_id long, a_ids array<int>, b_ids array<int>, cut_a array<int>, cut_b array<int>, "
           "by_a boolean, overlap_from array<int>, overlap_to array<int>")


def align_documents(docs: DataFrame, a: str, b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the ids of both tokenizers, the last A and B token of each group, and of each token of the
    shorter list (``by_a``: A's) the tokens of the other one from ``overlap_from`` to ``overlap_to`` that share a byte with it.

    ``a``: path of a byte-level tokenizers file, ``b``: of a sentencepiece model.  One pass, no shuffle.  Null and empty texts, and those
    that either tokenizer does not spell byte by byte, have empty lists; repeated rows and null keys each give a row.
    """
    names = [x.split()[0] for x in ALIGNED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(a, b)
        for batch in batches:
            for part in spans_of_rows(batch, "text"):
                rows = []
                for x in aligner.align([x or "" for x in part.column(1).to_pylist()]):
                    rows.append(([], [], [], [], None, [], []) if x is None else
                                (x.a, x.b, x.cut_a, x.cut_b, x.by_a, *x.overlaps()))
                lists = pa.list_(pa.int32())
                kinds = (lists, lists, lists, lists, pa.bool_(), lists, lists)
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, t) for c, t in zip(zip(*rows), kinds))], names)

    return docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).mapInArrow(handing_back(run), ALIGNED)


#: A chunk's documents (links: places in the chunk's pairs, little-endian unsigned 32-bit), and one row of its distinct pairs.
CHUNKS = ("chunk long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
          "links binary, pairs array<long>, counts array<long>")


def _chunks(docs: DataFrame, a: str, b: str) -> DataFrame:
    """Documents with their links, and for each chunk the distinct pairs (A id << 32 | B id) and how often it has them."""
    names = [x.split()[0] for x in CHUNKS.split(", ")]
    lists = pa.list_(pa.int64())
    kinds = (pa.int64(),) * 6 + (pa.string(), pa.binary(), lists, lists)

    def chunk_rows(chunk: int, held: list[tuple]) -> Iterator[pa.RecordBatch]:
        codes = [h[-1] for h in held]
        pairs, place, counts = np.unique(np.concatenate(codes), return_inverse=True, return_counts=True)
        data = place.astype("<u4").tobytes()
        ends = (4 * np.cumsum([len(c) for c in codes])).tolist()
        rows = [(chunk, *h[:-1], data[x:y], None, None) for h, x, y in zip(held, [0, *ends], ends)]
        rows.append((chunk, *[None] * 7, pairs, counts))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, task, done = Aligner(a, b), TaskContext.get().partitionId(), 0
        a_names, b_names = ([str(i) for i in range(len(t.bytes))] for t in (aligner.a, aligner.b))
        held, links = [], 0
        for batch in batches:
            for part in spans_of_rows(batch, "text"):
                found = aligner.align([x or "" for x in part.column(1).to_pylist()])
                for k, x in zip(part.column(0).to_pylist(), found):
                    if x is None:
                        held.append((k, 0, 0, 0, 0, "", np.empty(0, np.int64)))
                        continue
                    codes = x.a[x.cut_a] << 32 | x.b[x.cut_b]
                    held.append((k, len(x.a), len(x.b), len(x.cut_a), len(codes),
                                 hashlib.sha256(x.groups(a_names, b_names).encode()).hexdigest(), codes))
                    links += len(codes)
                if links >= CHUNK_LINKS:
                    yield from chunk_rows(task << 32 | done, held)
                    held, links, done = [], 0, done + 1
        if held:
            yield from chunk_rows(task << 32 | done, held)

    return docs.mapInArrow(handing_back(run), CHUNKS)


def pair_counts(chunks: DataFrame) -> DataFrame:
    """(pair, total, best): links of each pair of ids in the corpus, and whether no pair of its B id has more."""
    sums = chunks.groupBy("pair").agg(F.sum("n").alias("total")).withColumn("b", F.expr("pair & 4294967295"))
    most = sums.groupBy("b").agg(F.max("total").alias("most"))  # a row for each id of B
    return sums.join(most, "b").select("pair", "total", (F.col("total") == F.col("most")).alias("best"))


COUNTED = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def _sums(rows: DataFrame) -> DataFrame:
    """Sums over each document's links.  A chunk's pairs come first, in order, then its documents; one chunk is held at a time."""
    names = [x.split()[0] for x in COUNTED.split(", ")]
    kinds = (pa.int64(),) * 7 + (pa.string(),)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, totals, bests, parts = None, None, None, []
        for batch in batches:
            chunks = batch.column(0).to_numpy()
            edges = np.flatnonzero(np.r_[True, chunks[1:] != chunks[:-1]]) if len(chunks) else []
            for x, y in zip(edges, [*edges[1:], len(chunks)]):
                part = batch.slice(x, y - x)
                if chunks[x] != chunk:
                    chunk, totals, parts = chunks[x], None, []
                pairs = int(pa.compute.sum(pa.compute.is_valid(part.column(1))).as_py() or 0)
                if pairs:
                    parts.append((part.column(2).slice(0, pairs).to_numpy(), part.column(3).slice(0, pairs).to_numpy(zero_copy_only=False)))
                part = part.slice(pairs)
                if not part.num_rows:
                    continue
                if totals is None:
                    totals, bests = (np.concatenate(c) for c in zip(*parts)) if parts else (np.empty(0, np.int64),) * 2
                rows = part.select(names[:5]).to_pydict()
                sums = []
                for data in part.column("links"):
                    at = np.frombuffer(data.as_buffer(), "<u4") if len(data.as_buffer()) else np.empty(0, np.uint32)
                    sums.append((int(bests[at].sum()), int(totals[at].sum())))
                best, total = zip(*sums)
                columns = [*rows.values(), best, total, part.column("groups_sha256").to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    return rows.mapInArrow(handing_back(run), COUNTED)


def alignment_counts(docs: DataFrame, a: str, b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, tokens of A and B, groups, links, ``n_best`` (links whose corpus-wide count is the highest
    of their B id, ties included), ``count_sum`` (the counts of its links, summed) and the digest of its groups.

    Texts are read once and never move: documents' links move as places in their chunk's distinct
    pairs, pairs once for each chunk, however hot they are.  ``a``, ``b``, nulls and edge texts: see align_documents; a row
    without tokens has zeros and an empty digest.  No rows give none.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    chunks = stored(_chunks(rows, a, b), "alignment-chunks")
    own = chunks.where("pairs IS NOT NULL").select("chunk", F.posexplode(F.arrays_zip("pairs", "counts")).alias("place", "x"))
    own = own.select("chunk", "place", F.col("x.pairs").alias("pair"), F.col("x.counts").alias("n"))
    counts = stored(pair_counts(own), "pair-counts")
    back = own.join(counts.hint("merge"), "pair").select("chunk", "place", "total", "best")
    documents = chunks.where("pairs IS NULL").drop("pairs", "counts")
    columns = [x.split()[0] for x in COUNTED.split(", ")][:5]
    both = back.unionByName(documents.select("chunk", *columns, "groups_sha256", "links"), allowMissingColumns=True)
    both = both.repartition("chunk").sortWithinPartitions("chunk", F.col("place").asc_nulls_last())
    return _sums(both.select("chunk", "place", "total", "best", *columns, "groups_sha256", "links"))
