"""BPE encoding and decoding by a tokenization automaton.

The merges of a tokenizer are compiled into a deterministic automaton over tokens, one
merge gadget after the other.  It begins as one state with a loop for each
single symbol: every sequence of symbols is a path.  The gadget of a merge (u, v)
forbids u before v and lets their union do instead: the state that u leads to is copied
without its arc v, u now leads to the copy, and wherever there was an arc u there is
one for uv, to where v led.  After all gadgets a text has one path: its tokens.

All arcs of a label lead to one state, and a state differs from the one it was copied from by one arc,
as a label's arcs begin where those of its first part do.  So the automaton
is kept as tables of one entry a merge (the copied state, the arc that is missing, a label's
first part and merge), and an arc is looked up by following them; their size is the vocabulary's.

Texts are split into words as the tokenizer does; each distinct word is encoded once while
remembered.  Decoding emits the labels of the ids.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import handing_back, spans_of_rows
from tidewater.llm.token_files import byte_letters

#: Words whose ids, and arcs whose answers, a worker remembers; then it starts anew, so its memory is bounded.
REMEMBERED, ARCS = 400_000, 1_000_000
#: Pieces up to so many bytes take their transitions together, so many at a time.
TOGETHER, AT_A_TIME = 48, 20_000

#: Fixed value: the mark of a word's last symbol.
END = "</w>"
#: Fixed value: how the supported tokenizers cut text into pieces, after lower-casing.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: The same for printable ASCII without upper-case letters, and for letters that lower-casing and composing leave one by one.
ASCII_SPLIT = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
PRINTABLE = re.compile(rb"[!-~]+").fullmatch
LETTERS = re.compile(r"([^\W\d_]+)([.,;:!?]*)").fullmatch


class Automaton:
    """The compiled merges.  States and merges are numbered from 1; state 0 is where a path starts."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]]):
        size = max(vocabulary.values(), default=-1) + 1
        self.labels = [""] * size
        for label, i in vocabulary.items():
            self.labels[i] = label
        self.size = size
        self.leads_to = [0] * size  # the state that the arcs of a label lead to
        self.first, self.made = [-1] * size, [0] * size  # a label's first part, and the merge that made it
        self.copied, self.missing = [0] * (len(merges) + 1), [-1] * (len(merges) + 1)
        self.known: dict[int, bool] = {}
        unions = {a + b for a, b in merges}
        live = {i for label, i in vocabulary.items() if label not in unions}
        if len(unions) != len(merges):
            raise ValueError("two merges make the same token")
        for t, (a, b) in enumerate(merges, 1):
            u, v, uv = vocabulary[a], vocabulary[b], vocabulary[a + b]
            if u in live and v in live and self.arc(self.leads_to[u], v):  # else no path has u before v
                self.gadget(t, u, v, uv)
                live.add(uv)
        self.known = {}
        self._compile_spelling(live)

    def gadget(self, t: int, u: int, v: int, uv: int) -> None:
        self.first[uv], self.made[uv], self.leads_to[uv] = u, t, self.leads_to[v]
        self.copied[t], self.missing[t], self.leads_to[u] = self.leads_to[u], v, t

    def arc(self, state: int, label: int) -> bool:
        """Whether ``state`` has an arc ``label``.  Arcs that exist are never taken from a state again."""
        at = state * self.size + label
        answer = self.known.get(at)
        if answer is None:
            if len(self.known) > ARCS:
                self.known.clear()
            answer = True  # state 0 has every arc
            while state:
                if self.made[label] >= state:  # a label as old as the state or newer: where its first part goes out
                    label = self.first[label]
                elif label == self.missing[state]:
                    answer = False
                    break
                else:
                    state = self.copied[state]
            self.known[at] = answer
        return answer

    def _compile_spelling(self, live: set[int]) -> None:
        """Transitions by symbol: (node, symbol) -> node, and the label that ends at a node (-1: none).

        Symbols are bytes, those at the end of a word 256 more.  The transitions lie in
        a hash table of their own, so that many are read at once.
        """
        byte = {x: b for b, x in enumerate(byte_letters())}
        step: dict[int, int] = {}
        ends = [-1]
        for i in sorted(live):
            label = self.labels[i]
            last = 256 if label.endswith(END) else 0
            symbols = [byte[x] for x in (label[:-len(END)] if last else label)]
            symbols[-1] += last
            node = 0
            for x in symbols:
                node = step.setdefault(node * 512 + x, len(ends))
                if node == len(ends):
                    ends.append(-1)
            ends[node] = i
        self.step, self.ends = step, np.array(ends, np.int64)
        keys = np.fromiter(step.keys(), np.int64, len(step))
        values = np.fromiter(step.values(), np.int64, len(step))
        bits = max(4, int(4 * len(step)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.cells, self.nodes = np.full((1 << bits) + 64, -1, np.int64), np.zeros((1 << bits) + 64, np.int64)
        at = self._cell(keys)
        while len(keys):  # who finds its cell taken tries the next one
            free = self.cells[at] < 0
            self.cells[at[free]] = keys[free]
            placed = self.cells[at] == keys
            self.nodes[at[placed]] = values[placed]
            keys, values, at = keys[~placed], values[~placed], at[~placed] + 1

    def _cell(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def steps(self, nodes: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The node that each symbol leads to, or -1."""
        keys = nodes * 512 + symbols
        at = self._cell(keys)
        out = np.full(len(keys), -1, np.int64)
        asked = np.arange(len(keys))
        while len(asked):
            cells = self.cells[at]
            hit = cells == keys
            out[asked[hit]] = self.nodes[at[hit]]
            on = ~hit & (cells >= 0)
            keys, at, asked = keys[on], at[on] + 1, asked[on]
        return out

    def arcs(self, states: np.ndarray, labels: np.ndarray) -> np.ndarray:
        pairs, which = np.unique(states * self.size + labels, return_inverse=True)
        return np.array([self.arc(*divmod(x, self.size)) for x in pairs.tolist()], bool)[which]

    def path(self, word: bytes) -> list[int]:
        """The labels of the one path that spells ``word``."""
        n = len(word)
        symbols = [*word[:-1], word[-1] + 256]
        state, label, back = [-1] * (n + 1), [0] * (n + 1), [0] * (n + 1)
        state[0] = 0
        for i in range(n):
            node = 0
            for j in range(i, n):
                node = self.step.get(node * 512 + symbols[j], -1)
                if node < 0:
                    break
                x = int(self.ends[node])
                if x >= 0 and state[j + 1] < 0 and self.arc(state[i], x):
                    state[j + 1], label[j + 1], back[j + 1] = self.leads_to[x], x, i
        out, j = [], n
        while j:
            out.append(label[j])
            j = back[j]
        return out[::-1]

    def paths(self, words: list[bytes]) -> list[bytes]:
        """The same of many words of at most TOGETHER bytes, as little-endian unsigned 32-bit integers."""
        length = np.array([len(w) for w in words])
        order = np.argsort(-length, kind="stable")  # words that go on at a place come first
        length, words = length[order], [words[k] for k in order]
        n, widest = len(words), int(length[0])
        row = np.repeat(np.arange(n), length)
        column = np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)
        symbols = np.full((n, widest + 1), 0, np.int64)
        symbols[row, column] = np.frombuffer(b"".join(words), np.uint8)
        symbols[np.arange(n), length - 1] += 256
        state, label, back = (np.full((n, widest + 1), v, np.int64) for v in (-1, 0, 0))
        state[:, 0] = 0
        leads_to = np.array(self.leads_to)
        for i in range(widest):
            rows = np.arange(np.searchsorted(-length, -i))  # those longer than i
            nodes, found = np.zeros(len(rows), np.int64), []
            for j in range(i, widest):
                on = length[rows] > j
                rows, nodes = rows[on], nodes[on]
                nodes = self.steps(nodes, symbols[rows, j])
                on = nodes >= 0
                rows, nodes = rows[on], nodes[on]
                if not len(rows):
                    break
                x = self.ends[nodes]
                on = (x >= 0) & (state[rows, j + 1] < 0)
                found.append((rows[on], np.full(int(on.sum()), j + 1), x[on]))
            if found:
                at, j, x = (np.concatenate(c) for c in zip(*found))
                on = self.arcs(state[at, i], x)
                at, j, x = at[on], j[on], x[on]
                state[at, j], label[at, j], back[at, j] = leads_to[x], x, i
        used = np.zeros((n, widest + 1), bool)
        rows, j = np.arange(n), length
        while len(rows):
            used[rows, j] = True
            j = back[rows, j]
            rows, j = rows[j > 0], j[j > 0]
        ends = 4 * np.cumsum(used.sum(axis=1))
        data = label[used].astype("<u4").tobytes()
        out = [b""] * n
        for k, a, b in zip(order.tolist(), [0, *ends.tolist()], ends.tolist()):
            out[k] = data[a:b]
        return out


def read_tokenizer(path: str) -> dict:
    """The tokenizer's file, if it is of the kind that is supported; else ValueError."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, normal, split = spec["model"], spec["normalizer"], spec["pre_tokenizer"]
    steps = [x["type"] for x in normal["normalizers"]] if normal and normal["type"] == "Sequence" else None
    cuts = split["pretokenizers"] if split and split["type"] == "Sequence" else []
    fits = (
        model["type"] == "BPE" and model.get("end_of_word_suffix") == END
        and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
        and steps == ["NFC", "Replace", "Lowercase"] and normal["normalizers"][1]["pattern"] == {"Regex": r"\s+"}
        and [x["type"] for x in cuts] == ["Split", "ByteLevel"] and cuts[0]["pattern"] == {"Regex": SPLIT}
        and cuts[0]["invert"] and cuts[0]["behavior"] == "Removed" and not cuts[1]["add_prefix_space"] and not cuts[1]["use_regex"]
        and spec["decoder"] is None and spec["post_processor"] is None
        and not any(x["normalized"] or x["single_word"] or x["lstrip"] or x["rstrip"] for x in spec["added_tokens"]))
    if not fits:
        raise ValueError(f"{path}: not a lower-casing BPE with word ends whose words never hold white space")
    return spec


def compile_tokenizer(path: str) -> tuple[Automaton, dict[str, int]]:
    """The automaton of a tokenizer's file, and its special tokens."""
    spec = read_tokenizer(path)
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
    return Automaton(spec["model"]["vocab"], merges), {x["content"]: x["id"] for x in spec["added_tokens"]}


class Coder:
    """Ids of whole texts, and texts of ids; each word is cut, and each piece encoded, once while remembered."""

    def __init__(self, path: str, automaton: Automaton, special: dict[str, int]):
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)  # cuts unusual words; its model is not used
        self.normal, self.split = library.normalizer, library.pre_tokenizer
        self.automaton, self.special = automaton, special
        self.labels = list(automaton.labels)
        for x, i in special.items():
            self.labels += [""] * (i + 1 - len(self.labels))
            self.labels[i] = x
        self.marks = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.letters = {x: b for b, x in enumerate(byte_letters())}
        self.known: dict[bytes, bytes] = {}
        self.pieces: dict[bytes, bytes] = {}

    def cut(self, word: bytes) -> list[bytes | int]:
        """Pieces of a word between ASCII white space; a special token is its id."""
        text = word.decode()
        if not (self.marks and self.marks.search(text)):
            if PRINTABLE(word):
                return ASCII_SPLIT.findall(word.lower())
            lower = text.lower()
            plain = LETTERS(lower)  # below U+0250 lower-casing is by character and nothing composes
            if plain and max(lower) < "\u0250" and len(lower) == len(text):
                return [x.encode() for x in plain.groups() if x]
        out: list[bytes | int] = []
        for part in self.marks.split(text) if self.marks else [text]:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                out += [bytes(self.letters[c] for c in x)
                        for x, _ in self.split.pre_tokenize_str(self.normal.normalize_str(part))]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        split = [x.encode().split() for x in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        if len(self.pieces) > REMEMBERED:
            self.pieces.clear()
        cuts = {w: self.cut(w) for w in set().union(*split).difference(self.known)}
        new = [x for x in {x for c in cuts.values() for x in c}.difference(self.pieces)]
        short = [x for x in new if isinstance(x, bytes) and len(x) <= TOGETHER]
        short.sort(key=len)
        for k in range(0, len(short), AT_A_TIME):
            some = short[k:k + AT_A_TIME]
            self.pieces.update(zip(some, self.automaton.paths(some)))
        for x in new:
            if x not in self.pieces:
                ids = [x] if isinstance(x, int) else self.automaton.path(x)
                self.pieces[x] = np.array(ids, "<u4").tobytes()
        for w, c in cuts.items():
            self.known[w] = b"".join([self.pieces[x] for x in c])
        return [b"".join(map(self.known.__getitem__, s)) for s in split]

    def decode(self, ids: bytes) -> str:
        return " ".join(map(self.labels.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_CODERS: dict[str, Coder] = {}


def worker_coder(path: str, automaton: Automaton, special: dict[str, int]) -> Coder:
    """The coder of a Python worker, with the words of its earlier tasks (REMEMBERED at most)."""
    if path not in _CODERS:
        _CODERS.clear()
        _CODERS[path] = Coder(path, automaton, special)
    return _CODERS[path]


CODED = "doc_id long, ids binary, decoded string"


def code_documents(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, ``ids`` of the whole text (little-endian unsigned 32-bit), ``decoded``: the labels of those ids.

    ``tokenizer``: path of a tokenizers file that every executor can read; another kind than that of the
    module raises.  The automaton is compiled once, at the driver.  One pass, no shuffle.
    Special tokens' strings in a text are those tokens, as in the library.  A null or empty
    text has no ids and an empty decoded text; repeated rows and null keys each give a row; no rows give none.
    """
    automaton, special = compile_tokenizer(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = worker_coder(tokenizer, automaton, special)
        for batch in batches:
            for part in spans_of_rows(batch, "text"):
                ids = coder.encode([x or "" for x in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ids, pa.binary()), pa.array([coder.decode(x) for x in ids], pa.string())],
                    ["doc_id", "ids", "decoded"])

    return docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).mapInArrow(handing_back(run), CODED)


def code_digests(coded: DataFrame) -> DataFrame:
    """Number and digest of the ids, digest of the decoded text."""
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
