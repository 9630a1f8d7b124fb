"""Byte-level BPE encoding and decoding.

Texts are cut at white space together, as arrays of bytes, and what stands between is split by
the pattern in Python, once while remembered; each distinct word of a task is then
encoded by Spark higher-order functions.  For most words a fold over the places of tokens in the word, which are looked up
where the word is split off, makes them by rank and from left to right, on the word's boundaries as bits.  For longer ones a fold over the
byte array merges the pair of lowest rank, leftmost first, until none is left; the ranks
are a literal map in the plan.  Decoding concatenates the binary pieces of
the ids.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import re
import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import handing_back, spans_of_rows

#: Longer words are merged with a heap in Python: a fold copies its array at each merge.
LONGEST = 128
#: Distinct words a task remembers before it starts anew, and stretches between white space; bytes of text split at a time.
REMEMBERED, SLICE_BYTES = 600_000, 4 << 20
#: New words handed on at a time.
HANDED = 16_000
#: Words whose places of tokens are looked for at a time.
TOGETHER = 4000
#: Bytes of a word whose boundaries and their marks fit a long; longer words are folded as arrays of their pieces.
MASKED = 30
#: The public pattern, which never joins what white space separates but for one space before a word,
#: its white space, and the stretches that it cuts one by one.
PUBLIC = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACES = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: White space of two and of three bytes in UTF-8, as numbers.
WIDE = {size: [int.from_bytes(x.encode()) for x in re.findall(f"[{SPACES}]", "".join(map(chr, those)))]
        for size, those in ((2, range(0x80, 0x800)), (3, range(0x800, 0xD800)))}
#: A rank that says "no merge", and the id before and after a word; real ids are smaller.
NONE, EDGE = 1 << 16, (1 << 16) - 1


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def pair_ranks(ranks: dict[bytes, int]) -> list[tuple[int, int, int]]:
    """(left id, right id, rank of the two together) of every pair that may merge."""
    if max(ranks.values(), default=0) >= EDGE - 1:
        raise ValueError("ids must be under 65534")
    return [(ranks[p[:k]], ranks[p[k:]], r) for p, r in ranks.items() for k in range(1, len(p))
            if p[:k] in ranks and p[k:] in ranks]


#: Cells of the two halves of the rank map ; a pair has one place in either.
HALVES = (141_311, 150_889)


def rank_map(ranks: dict[bytes, int]) -> Column:
    """The pair ranks as a literal array<bigint>: the pair's ids and its rank, as bits
    (left << 32 | right << 16 | rank), in one of the pair's two places, so that a lookup reads two cells."""
    first, second = HALVES
    empty = 0  # differs above bit 16 from every pair but the first, whose two places get another value
    cells = [empty] * (first + second)
    cells[0] = cells[first] = other = 1 << 62
    for left, right, rank in pair_ranks(ranks):
        entry, place = left << 32 | right << 16 | rank, None
        for _ in range(500):  # an entry that finds its place taken sends the other one to its second place
            key = entry >> 16
            place = first + key % second if place == key % first else key % first
            entry, cells[place] = cells[place], entry
            if entry in (empty, other):
                break
        else:
            raise ValueError("too many pairs for the rank map")
    return F.from_json(F.lit(json.dumps(cells)), "array<bigint>")


def _bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), body)[0]


def _pair(a: Column, b: Column) -> Column:
    return F.shiftleft(a, 16).bitwiseOR(b)


def _rank(m: Column, pair: Column) -> Column:
    """Rank of a pair of ids, or NONE: a cell of another pair differs above bit 16."""
    first, second = HALVES
    marks = F.shiftleft(pair, 16)
    return F.least(F.get(m, (pair % F.lit(first)).cast("int")).bitwiseXOR(marks),
                   F.get(m, (pair % F.lit(second)).cast("int") + F.lit(first)).bitwiseXOR(marks), F.lit(NONE).cast("long"))


class Spans:
    """All places of tokens in words, found by a walk through the tokens' prefixes.

    ``regular`` says that every token that merges can make at all comes from a pair in its turn: merging its bytes by
    the pairs of lower rank leaves two pieces.  Then a stretch of a word whose ends stay ends becomes the token in its turn or never.
    """

    SLOTS = 1 << 19  # 32 bits less 13

    def __init__(self, ranks: dict[bytes, int]):
        import numpy as np

        self.regular, tokens = True, {}
        for token, rank in ranks.items():
            if len(token) == 1:
                tokens[token] = rank
            elif len(parts := self.pieces(token, ranks, rank)) == 2:
                tokens[token] = rank
            elif len(self.pieces(token, ranks, NONE)) == 1:
                self.regular = False
        nodes = {bytes([x]): x for x in range(256)}
        keys, children = [], []
        for token in tokens:
            for end in range(2, len(token) + 1):
                if token[:end] not in nodes:
                    keys.append(nodes[token[:end - 1]] << 8 | token[end - 1])
                    children.append(len(nodes))
                    nodes[token[:end]] = len(nodes)
        self.rank = np.full(len(nodes), -1, np.int32)
        for token, rank in tokens.items():
            self.rank[nodes[token]] = rank
        # the next nodes, in lists by slot
        self.key, self.child = np.array(keys, np.int32), np.array(children, np.int32)
        self.head, self.after = np.full(self.SLOTS, -1, np.int32), np.full(len(keys), -1, np.int32)
        for k, slot in enumerate(self.slots(self.key).tolist()):
            self.after[k], self.head[slot] = self.head[slot], k

    def slots(self, key):
        import numpy as np

        return key.astype(np.uint32) * np.uint32(0x9E3779B1) >> np.uint32(13)

    @staticmethod
    def pieces(token: bytes, ranks: dict[bytes, int], under: int) -> list[bytes]:
        """The pieces of ``token`` after all merges of a rank less than ``under``."""
        parts = [token[k:k + 1] for k in range(len(token))]
        while len(parts) > 1:
            rank, k = min((ranks.get(a + b, NONE), k) for k, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank >= under:
                break
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def find(self, text, begin, sizes):
        """(word, start, length, rank) of every token in words of ``text``; ``begin`` and ``sizes`` are the words'."""
        import numpy as np

        begin, sizes = begin.astype(np.int32), sizes.astype(np.int32)
        word = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        at = np.arange(len(word), dtype=np.int32) + np.repeat(begin - (np.cumsum(sizes, dtype=np.int32) - sizes), sizes)
        start = at - begin[word]
        node, left, length, out = text[at], sizes[word] - start, 1, []
        while len(node):
            rank = self.rank[node]
            token = np.flatnonzero(rank >= 0)
            out.append((word[token], start[token], np.full(len(token), length, np.int32), rank[token]))
            more = np.flatnonzero(left > length)
            key = node[more] << 8 | text[at[more] + length]
            place = self.head[self.slots(key)]
            todo = np.flatnonzero(place >= 0)
            while len(todo := todo[self.key[place[todo]] != key[todo]]):
                place[todo] = self.after[place[todo]]
                todo = todo[place[todo] >= 0]
            found = np.flatnonzero(place >= 0)
            node, more = self.child[place[found]], more[found]
            word, at, start, left, length = word[more], at[more], start[more], left[more], length + 1
        return [np.concatenate(x) for x in zip(*out)]


class Start:
    """State of a word before the first merge, as an array of longs.

    Of a word of MASKED bytes at most: -1 - the number of longer tokens in it; its boundaries, a bit for each; a mask
    for each place of a token in the word, longer ones by rank and from left to right, then single bytes: the bits of its ends << 32 |
    the bits between them; then, in the same order, start << 16 | id of each.

    Of another word: an entry for each byte between two edges.  An entry has, as bits, the rank of its merge with the next piece (NONE: no
    merge), the index of the entry before it and its id: rank << 32 | index << 16 | id.
    """

    def __init__(self, ranks: dict[bytes, int]):
        import numpy as np

        single = [ranks[bytes([x])] for x in range(256)]
        self.pairs = np.array([[ranks.get(bytes([a, b]), NONE) << 32 | single[a] for b in range(256)] for a in range(256)], np.int64).ravel()
        self.lasts = np.array([NONE << 32 | x for x in single], np.int64)
        self.spans = Spans(ranks)
        self.masked = MASKED if self.spans.regular else 0

    def __call__(self, word: bytes) -> list[int]:
        return self.many([word], [True]).to_pylist()[0]

    def many(self, words: list[bytes], rows: list[bool]) -> pa.ListArray:
        """The states of ``words``, a list at each true one of ``rows`` and a null at the others."""
        import numpy as np

        parts = [self.states(words[k:k + TOGETHER]) for k in range(0, len(words), TOGETHER)] or [(np.empty(0, np.int64),) * 2]
        lengths, out = map(np.concatenate, zip(*parts))
        offsets, mask = np.zeros(len(rows), np.int64), np.array(rows, bool)
        offsets[mask] = lengths
        return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(offsets)], pa.int32()), pa.array(out), mask=pa.array(~mask))

    def states(self, words: list[bytes]):
        """Length of each word's state, and the states one after the other."""
        import numpy as np

        sizes = np.fromiter(map(len, words), np.int64, len(words))
        text, begin = np.frombuffer(b"".join(words), np.uint8).astype(np.int32), np.cumsum(sizes) - sizes
        short, long = np.flatnonzero(sizes <= self.masked), np.flatnonzero(sizes > self.masked)
        word, start, length, rank = self.spans.find(text, begin[short], sizes[short]) if len(short) else (np.empty(0, np.int32),) * 4
        own = np.bincount(word, minlength=len(short))  # tokens in each word
        lengths = sizes + 2
        lengths[short] = 2 + 2 * own
        to = np.cumsum(lengths) - lengths
        out = np.empty(lengths.sum(), np.int64)
        # places of tokens
        key = np.sort(word.astype(np.int64) << 32 | (length == 1).astype(np.int64) << 31 | rank.astype(np.int64) << 12 | start << 6 | length)
        start, length, rank, word = key >> 6 & 63, key & 63, key >> 12 & 0xFFFF, key >> 32
        place = to[short][word] + 2 + np.arange(len(key)) - (np.cumsum(own) - own)[word]
        one = np.int64(1)
        ends = one << start | one << start + length
        out[place] = ends << 32 | ((one << length - 1) - 1) << start + 1
        out[place + own[word]] = start << 16 | rank
        out[to[short]] = -1 - (own - sizes[short])  # each byte is a token
        out[to[short] + 1] = (one << sizes[short] + 1) - 1
        # entries of bytes
        word = np.repeat(long, sizes[long])
        at = np.arange(len(word)) - np.repeat(np.cumsum(sizes[long]) - sizes[long], sizes[long])
        place, source = to[word] + 1 + at, begin[word] + at
        out[to[long]] = out[to[long] + sizes[long] + 1] = NONE << 32 | EDGE
        last = at == sizes[word] - 1
        after = text[np.minimum(source + 1, len(text) - 1)] if len(text) else text
        out[place] = np.where(last, self.lasts[text[source]], self.pairs[text[source] << 8 | after]) | at << 16
        out[to[long] + sizes[long] + 1] |= sizes[long] << 16
        return lengths, out


def fold_spans(state: Column) -> Column:
    """Ids after all ranked merges, from the masks of a word's tokens (see Start).

    The fold takes the tokens by rank, those of one rank from left to right.  One is made where its ends are boundaries and one boundary
    is left between them, which goes.  The fold's value has the boundaries in its low half and those gone in its high half, so what it shares
    with a mask says all: a single bit in the low half if the token is made, nothing if it is one of the pieces at the end.
    """
    half, one = F.lit(1 << 32).cast("long"), F.lit(1)
    size = ((F.size(state) - 2) / 2).cast("int")

    def step(s: Column, c: Column) -> Column:
        shared = s.bitwiseAND(c)
        made = (shared < half) & (F.bit_count(shared) == one)
        return F.when(made, s + shared * F.lit((1 << 32) - 1).cast("long")).otherwise(s)

    def pieces(s: Column) -> Column:
        left = F.zip_with(F.slice(state, 3, size), F.slice(state, size + 3, size),
                          lambda c, v: F.when(s.bitwiseAND(c) == F.lit(0).cast("long"), v))
        return F.transform(F.sort_array(F.array_compact(left)), lambda v: v.bitwiseAND(F.lit(0xFFFF).cast("long")))

    longer = (F.lit(-1).cast("long") - F.get(state, F.lit(0))).cast("int")
    return _bind(F.aggregate(F.slice(state, 3, longer), F.get(state, F.lit(1)), step), pieces)


def fold_merges(state: Column, m: Column) -> Column:
    """Ids after all ranked merges, from the entries of a word's bytes (see Start).

    The least entry is the next merge, the leftmost of equal ranks, and its rank
    is the id that it makes; the entry before it and its own get their new ranks, the one after it goes.
    """
    def const(x: int) -> Column:
        return F.lit(x).cast("long")

    low, index, one = const(0xFFFFFFFF), const(EDGE << 16), const(1 << 16)

    def of(x: Column) -> Column:
        return x.bitwiseAND(const(EDGE))

    def entry(pair: Column, rest: Column) -> Column:
        return F.shiftleft(_rank(m, pair), 32).bitwiseOR(rest)

    def step(a: Column, _: Column) -> Column:
        def put(least: Column) -> Column:
            j = F.shiftright(least, 16).bitwiseAND(const(EDGE)).cast("int")  # the piece before the merge
            before, new = F.get(a, j), F.shiftright(least, 32)
            pairs = F.array(_pair(of(before), new), _pair(new, of(F.get(a, j + 3))))
            rests = F.array(before.bitwiseAND(low), least.bitwiseAND(index).bitwiseOR(new))
            return F.flatten(F.array(F.slice(a, 1, j), F.zip_with(pairs, rests, entry),
                                     F.transform(F.slice(a, j + 4, F.size(a)), lambda x: x - one)))

        return _bind(F.array_min(a), lambda least: F.when(least >= const(NONE << 32), a).otherwise(put(least)))

    turns = F.sequence(F.lit(1), F.greatest(F.size(state) - 3, F.lit(1)))
    return F.aggregate(turns, state, step, lambda a: F.transform(F.slice(a, 2, F.size(a) - 2), of))


def encode_words(words: DataFrame, ranks: dict[bytes, int], column: str = "state") -> DataFrame:
    """``words`` with ``ids`` (array<bigint>); ``column`` has the start state of each word (null: none)."""
    state = F.col(column)
    return words.withColumn("ids", F.when(state.isNull(), None).when(F.get(state, F.lit(0)) < 0, fold_spans(state)).otherwise(
        _bind(rank_map(ranks), lambda m: fold_merges(state, m))))


def decode_ids(rows: DataFrame, ranks: dict[bytes, int], ids: str = "ids") -> DataFrame:
    """``rows`` with ``decoded``: the binary pieces of ``ids`` one after the other."""
    pieces = [""] * (max(ranks.values(), default=-1) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece.decode("latin-1")
    table = F.from_json(F.lit(json.dumps(pieces)), "array<string>")
    return rows.withColumn("decoded", _bind(table, lambda t: F.encode(F.array_join(F.transform(
        F.col(ids), lambda i: F.get(t, i.cast("int"))), ""), "ISO-8859-1")))


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges with a heap, for very long words."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    end, before, after = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    alive = [True] * n
    heap: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j < n and (rank := ranks.get(word[i:end[j]])) is not None:
            heapq.heappush(heap, (rank, i, end[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or after[i] >= n or end[after[i]] != stop or end[i] >= stop:
            continue
        j = after[i]
        alive[j], end[i], after[i] = False, stop, after[j]
        if after[j] < n:
            before[after[j]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i:end[i]]])
        i = end[i]
    return out


SPLIT = "reset boolean, state array<bigint>, known array<bigint>, key long, codes binary"
ENCODED = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def stretches(text, edges):
    """Where the stretches of texts begin, as the public pattern keeps them apart.

    ``text`` has the texts' bytes in UTF-8, ``edges`` where each begins and the end.  A stretch is a run without white space and
    the space before it, if one is there, or a run of white space; of one before anything else in its text, the last character is cut off:
    it goes to what follows if it is a space and is a stretch of its own if not.
    """
    import numpy as np

    white = (text - np.uint8(9) < 5) | (text == 32)
    wide = np.flatnonzero((text == 0xC2) | (text - np.uint8(0xE1) < 3))
    last = len(text) - 1
    for size, those in WIDE.items():
        key = np.zeros(len(wide), np.int32)
        for k in range(size):
            key = key << 8 | text[np.minimum(wide + k, last)]
        places = wide[np.isin(key, those)]
        for k in range(size):
            white[places + k] = True
    first = np.zeros(len(text) + 1, bool)
    first[edges] = True
    first = first[:-1]
    begins = first.copy()
    begins[1:] |= white[1:] != white[:-1]
    after = np.flatnonzero(begins & ~(white | first))  # white space is before them
    before = text[after - 1]
    begins[after[before == 32]] = False
    begins[after - np.where(before < 0x80, 1, np.where(text[after - 2] >= 0xC0, 2, 3))] = True
    return np.flatnonzero(begins)


class Codes(dict):
    """Stretch of a text to the codes of its words, as bytes; ``new`` holds the words that are not taken over yet."""

    def __init__(self, pattern: str):
        super().__init__()
        import regex

        self.words: dict[str, bytes] = {}  # words of stretches of several
        self.count = 0
        self.new: list[str] = []
        self.find = regex.compile(pattern).findall
        self.public = pattern == PUBLIC  # the stretches of another pattern are whole texts

    def clear(self) -> None:
        super().clear()
        self.words.clear()
        self.count = 0

    def code(self, word: str) -> bytes:
        code = self.words.get(word) or self.get(word)
        if code is None:
            code = self.words[word] = self.count.to_bytes(4, sys.byteorder)
            self.count += 1
            self.new.append(word)
        return code

    def __missing__(self, stretch: str) -> bytes:
        if not self.public:
            return b"".join(map(self.code, self.find(stretch)))
        # letters alone, with a space before them or not, are a word
        if stretch.isalpha() or stretch[0] == " " and stretch[1:].isalpha():
            codes = self.words.pop(stretch, None)
            if codes is None:
                codes = self.count.to_bytes(4, sys.byteorder)
                self.count += 1
                self.new.append(stretch)
        else:
            words = self.find(stretch)
            if words == [stretch]:
                codes = self.code(stretch)
                self.words.pop(stretch, None)
            else:
                codes = b"".join(map(self.code, words))
        self[stretch] = codes
        return codes

    def of(self, text: str) -> bytes:
        return self.many(pa.array([text]))[0].as_py()

    def many(self, texts: pa.StringArray) -> pa.BinaryArray:
        """The codes of each text; a null has none.  Equal stretches of the texts are looked up once."""
        import numpy as np

        texts = pc.fill_null(texts.cast(pa.string()), "")
        edges = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
        if edges[0] == edges[-1]:
            return pa.array([b""] * len(texts), pa.binary())
        text, edges = np.frombuffer(texts.buffers()[2], np.uint8)[edges[0]:edges[-1]], edges - edges[0]
        begin = stretches(text, edges) if self.public else np.unique(edges[:-1][np.diff(edges) > 0])
        offsets = np.append(begin, len(text)).astype(np.int32)
        found = pa.StringArray.from_buffers(len(begin), pa.py_buffer(offsets), pa.py_buffer(text)).dictionary_encode()
        which = found.indices.to_numpy()
        codes = list(map(self.__getitem__, found.dictionary.to_numpy(zero_copy_only=False)))
        sizes = np.fromiter(map(len, codes), np.int64, len(codes)) >> 2
        own = sizes[which]
        ends = np.append(0, np.cumsum(own))
        place = np.arange(ends[-1]) + np.repeat((np.cumsum(sizes) - sizes)[which] - ends[:-1], own)
        out = np.frombuffer(b"".join(codes), np.int32)[place]
        to = pa.array(4 * ends[np.searchsorted(begin, edges)], pa.int32())
        return pa.BinaryArray.from_buffers(pa.binary(), len(texts), [None, to.buffers()[1], pa.py_buffer(out)])


def _split(docs: DataFrame, ranks_path: str, start: Start, pattern: str, key: str, text: str) -> DataFrame:
    """A stream of rows for each task: new words in order of their codes, then the documents that need them.

    Codes count the words a task has met; ``reset`` says that they count from 0 again.
    """
    kinds = {"reset": pa.bool_(), "state": pa.list_(pa.int64()), "known": pa.list_(pa.int64()), "key": pa.int64(), "codes": pa.binary()}

    def rows(n: int, **columns: pa.Array) -> pa.RecordBatch:
        columns.setdefault("reset", pa.array([False] * n))
        return pa.RecordBatch.from_arrays([columns[x] if x in columns else pa.nulls(n, kind) for x, kind in kinds.items()], list(kinds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, codes = read_ranks(ranks_path), Codes(pattern)
        for batch in batches:
            for part in spans_of_rows(batch, "text", SLICE_BYTES):
                if max(len(codes), codes.count) > REMEMBERED:
                    codes.clear()
                    yield rows(1, reset=pa.array([True]))
                own = codes.many(part.column(1))
                new = codes.new[:]
                codes.new.clear()
                for k in range(0, len(new), HANDED):
                    words = [w.encode() for w in new[k:k + HANDED]]
                    known = [[ranks[w]] if w in ranks else None if len(w) <= LONGEST else merge_long(w, ranks) for w in words]
                    fold = [x is None for x in known]
                    yield rows(len(words), state=start.many([w for w, x in zip(words, fold) if x], fold),
                               known=pa.array(known, kinds["known"]))
                yield rows(part.num_rows, key=part.column(0), codes=own)

    return docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).mapInArrow(handing_back(run), SPLIT)


class Pieces:
    """What a task's words, in order of their codes, give to the digests of its documents."""

    def __init__(self):
        self.tokens = [pa.array([], pa.int64())]
        self.shown, self.decoded = ([pa.array([], pa.large_binary())] for _ in range(2))

    def add(self, words: pa.RecordBatch) -> None:
        ids = words.column("ids")  # every word has one at least
        self.tokens.append(pc.list_value_length(ids).cast(pa.int64()))
        ids = pa.ListArray.from_arrays(ids.offsets, ids.values.cast(pa.string()))
        self.shown.append(pc.binary_join_element_wise("", pc.binary_join(ids, " "), " ").cast(pa.large_binary()))
        self.decoded.append(words.column("decoded").cast(pa.large_binary()))

    def digests(self, codes: pa.BinaryArray) -> tuple[pa.Array, pa.Array, pa.Array]:
        """Number of the ids of each list of codes, the digest of the ids as text and that of the bytes they decode to."""
        import numpy as np

        for parts in (self.tokens, self.shown, self.decoded):
            if len(parts) > 1:
                parts[:] = [pa.concat_arrays(parts)]
        edges = np.frombuffer(codes.buffers()[1], np.int32)[codes.offset:codes.offset + len(codes) + 1] >> 2
        own = np.frombuffer(codes.buffers()[2] or b"", np.int32)[edges[0]:edges[-1]]
        edges = edges - edges[0]
        tokens = np.append(0, np.cumsum(self.tokens[0].to_numpy()[own]))[edges]

        def hashed(pieces: pa.LargeBinaryArray, skip: int) -> pa.Array:
            taken = pieces.take(pa.array(own))
            ends, data = np.frombuffer(taken.buffers()[1], np.int64)[edges].tolist(), memoryview(taken.buffers()[2] or b"")
            return pa.array([hashlib.sha256(data[a + skip:b]).hexdigest() for a, b in zip(ends, ends[1:])], pa.string())

        return pa.array(np.diff(tokens)), hashed(self.shown[0], 1), hashed(self.decoded[0], 0)


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id",
                     text: str = "text") -> DataFrame:
    """Number and digests of each whole text's ids, and the digest of the bytes that they decode to.

    One pass without a shuffle: words repeat within a task and are encoded once
    for it.  A null or empty text has no ids; repeated rows and null keys
    each give a row; no rows give none.  Words over LONGEST bytes (a text
    without white space, say) are merged exactly by a heap.
    """
    ranks = read_ranks(ranks_path)
    rows = _split(docs, ranks_path, Start(ranks), pattern, key, text)
    rows = encode_words(rows, ranks).withColumn("ids", F.coalesce("known", "ids")).drop("state", "known")
    rows = decode_ids(rows, ranks)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Pieces()
        for batch in batches:
            starts = pc.indices_nonzero(batch.column("reset")).to_pylist()
            for begin, end in zip([0, *starts], [*starts, batch.num_rows]):
                if begin in starts:
                    words = Pieces()
                some = batch.slice(begin, end - begin)
                words.add(some.filter(pc.is_valid(some.column("ids"))))
                for part in spans_of_rows(some.filter(pc.is_valid(some.column("codes"))), "codes", SLICE_BYTES):
                    yield pa.RecordBatch.from_arrays([part.column("key"), *words.digests(part.column("codes"))],
                                                     ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return rows.select("reset", "key", "codes", "ids", "decoded").mapInArrow(handing_back(join), ENCODED)
