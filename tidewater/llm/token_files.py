"""Token ids in seekable binary files.

A file is a run of independent zstandard frames followed by a seek table in a
skippable frame (the public zstd seekable format): compressed size, size and
xxh64 checksum of every frame.  A reader takes the table from the end of the
file and decompresses only the frames that hold the documents asked for.

A frame's content: number of documents; for each its doc_id, a flag for a null
doc_id, its number of ids; then all ids as little-endian unsigned 32-bit.
"""

from __future__ import annotations

import string
import struct
import sys
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import arrow, handing_back, spans_of_rows, stored
from tidewater.session import scratch_path

#: Fixed values of the zstd seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
FOOTER, FOOTER_BYTES = "<IBI", 9
ENTRY, ENTRY_BYTES = "<III", 12
CHECKSUMS = 0x80

FRAME_BYTES = 1 << 20
#: Words whose ids a worker remembers; then it starts anew, so its memory is bounded.
REMEMBERED = 400_000

INDEX = "file string, part int, frame int, n_docs long, n_tokens long, first_doc long, last_doc long"


def byte_letters() -> list[str]:
    """The public byte-level alphabet: printable bytes stand for themselves, the others for characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


#: ASCII marks, which are neither letters nor numbers: after letters a run of them is one piece of the pre-tokenizer.
ASCII_MARKS = string.punctuation.encode()


class Known(dict):
    """Word to ids; a word that is not there yet is encoded."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: bytes) -> bytes:
        ids = self[word] = self.encode(word)
        return ids


class Encoder:
    """Ids of whole texts by a tokenizer that lower-cases, drops white space and splits letters from the rest.

    Its splits never cross white space and words repeat, so each is given to the
    tokenizers library once while remembered.  A word of plain lower-case letters is
    one piece of the pre-tokenizer and goes straight to the library's model, as does what stands
    before marks at the end, and the marks; every other word takes the whole way.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = dict(enumerate(byte_letters()))
        self.known = Known(self.new)
        # a special token of marks alone could be part of those at the end
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.marks = ASCII_MARKS if all(any(c.isalpha() for c in x) for x in special) else b""

    def whole(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def piece(self, letters: str) -> bytes:
        ids = array("I", [t.id for t in self.model.tokenize(letters)])
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def new(self, word: bytes) -> bytes:
        base = word.rstrip(self.marks)
        end = word[len(base):]
        base = base.lower()  # A-Z only
        if base.isalpha():  # ASCII letters
            ids = self.known.get(base)  # without encoding it as a word
            if ids is None:
                ids = self.known[base] = self.piece(base.decode("ascii"))
        else:
            shown = base.decode()
            lower = shown.lower()
            # below U+0250 lower-casing is by character and nothing composes
            if not (lower.isalpha() and max(lower) < "\u0250" and len(lower) == len(shown)):
                return self.whole(word.decode())
            ids = self.piece(lower.encode().decode("latin-1").translate(self.letters))
        if end:
            if end not in self.known:
                self.known[end] = self.piece(end.decode())
            ids += self.known[end]
        return ids

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        ids = self.known.__getitem__
        return [b"".join(map(ids, x.encode().split())) for x in texts]


_ENCODERS: dict[str, Encoder] = {}


def worker_encoder(path: str) -> Encoder:
    """The encoder of a Python worker, with the words of its earlier tasks (REMEMBERED at most)."""
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


class FrameWriter:
    """Writes one file; ``frames`` holds what the index says of each frame."""

    def __init__(self, folder: str, part: int, frame_bytes: int = FRAME_BYTES):
        fs, path = pyarrow.fs.FileSystem.from_uri(folder)
        fs.create_dir(path, recursive=True)
        # an attempt that fails leaves a file that no index names
        self.name = f"part-{part:06d}-{uuid.uuid4().hex}.ids.zst"
        self.out, self.part, self.most = fs.open_output_stream(f"{path}/{self.name}", compression=None), part, frame_bytes
        self.packer = zstandard.ZstdCompressor(level=3)
        self.entries, self.frames, self.held, self.size = [], [], [], 0

    def add(self, doc: int | None, ids: bytes) -> None:
        if self.held and self.size + len(ids) > self.most:
            self.flush()
        self.held.append((doc, ids))
        self.size += len(ids)

    def flush(self) -> None:
        if not self.held:
            return
        docs = [d for d, _ in self.held]
        data = b"".join([
            struct.pack("<I", len(docs)), np.array([d or 0 for d in docs], "<i8").tobytes(),
            np.array([d is None for d in docs], "u1").tobytes(),
            np.array([len(x) // 4 for _, x in self.held], "<u8").tobytes(), *(x for _, x in self.held)])
        packed = self.packer.compress(data)
        self.out.write(packed)
        self.entries.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        self.frames.append((self.name, self.part, len(self.frames), len(docs), self.size // 4, docs[0], docs[-1]))
        self.held, self.size = [], 0

    def close(self) -> list[tuple]:
        self.flush()
        table = b"".join(struct.pack(ENTRY, *e) for e in self.entries)
        table += struct.pack(FOOTER, len(self.entries), CHECKSUMS, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)
        self.out.close()
        return self.frames


class FrameReader:
    """Random access to the frames of one file by its seek table."""

    def __init__(self, folder: str, name: str):
        fs, path = pyarrow.fs.FileSystem.from_uri(folder)
        self.file = fs.open_input_file(f"{path}/{name}")
        size = self.file.size()
        count, flags, magic = struct.unpack(FOOTER, self.file.read_at(FOOTER_BYTES, size - FOOTER_BYTES))
        if magic != SEEKABLE_MAGIC or flags != CHECKSUMS:
            raise ValueError(f"{name}: no seek table with checksums at its end")
        raw = self.file.read_at(count * ENTRY_BYTES, size - FOOTER_BYTES - count * ENTRY_BYTES)
        self.entries = list(struct.iter_unpack(ENTRY, raw))
        self.starts = np.concatenate([[0], np.cumsum([e[0] for e in self.entries], dtype=np.int64)])
        self.unpacker = zstandard.ZstdDecompressor()

    def frame(self, k: int) -> tuple[list, np.ndarray, np.ndarray]:
        """doc_ids, number of ids of each, all ids of frame ``k``; a wrong checksum raises."""
        packed, size, check = self.entries[k]
        data = self.unpacker.decompress(self.file.read_at(packed, int(self.starts[k])), max_output_size=size)
        if len(data) != size or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {k}: wrong checksum")
        (n,) = struct.unpack_from("<I", data)
        docs = np.frombuffer(data, "<i8", n, 4).tolist()
        null = np.frombuffer(data, "u1", n, 4 + 8 * n)
        counts = np.frombuffer(data, "<u8", n, 4 + 9 * n).astype(np.int64)
        return [None if x else d for d, x in zip(docs, null)], counts, np.frombuffer(data, "<u4", offset=4 + 17 * n)


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1, key: str = "doc_id",
                 text: str = "text", frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """Encode every whole text and write the ids, ``end_id`` after each document, in ascending ``key`` order.

    Returns the index, a row for each frame, kept as Parquet beside the files:
    it names only files of tasks that Spark committed.  One range exchange of the
    texts; a task holds one frame.  A null text is empty (only ``end_id``), null keys
    come first, repeated keys stay separate documents in order of their text; a text longer than a
    frame gets a frame of its own.  A tokenizer of another kind than the Encoder's raises.
    """
    from tidewater.llm.tokenization_automaton import read_tokenizer

    read_tokenizer(tokenizer)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder, writer, end = worker_encoder(tokenizer), None, struct.pack("<I", end_id)
        for batch in batches:
            for part in spans_of_rows(batch, "text"):
                writer = writer or FrameWriter(folder, TaskContext.get().partitionId(), frame_bytes)
                texts = [x or "" for x in part.column(1).to_pylist()]
                for doc, ids in zip(part.column(0).to_pylist(), encoder.encode(texts)):
                    writer.add(doc, ids + end)
        names = [x.split()[0] for x in INDEX.split(", ")]
        if writer:
            yield arrow(INDEX, **dict(zip(names, zip(*writer.close()))))

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    ordered = rows.repartitionByRange(F.col("key").asc_nulls_first()).sortWithinPartitions(F.col("key").asc_nulls_first(), "text")
    return stored(ordered.mapInArrow(handing_back(write), INDEX), "token-index")


def frame_starts(index: DataFrame) -> DataFrame:
    """``index`` with ``start``: ids before each frame.  Only one row a file meets in one task."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("part").orderBy("frame").rowsBetween(Window.unboundedPreceding, -1)
    files = (index.groupBy("part").agg(F.sum("n_tokens").alias("n"))
             .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    return (index.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
            .join(files, "part").withColumn("start", F.col("base") + F.col("inside")).drop("base", "inside"))


#: Ids that a task reads back, about.
TASK_TOKENS = 4 << 20
DOCS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def read_tokens(index: DataFrame, folder: str, wanted: list[int] | None = None) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, or of ``wanted`` (a small list), from the files.

    With ``wanted`` only frames whose doc_id range holds one of them are read.  The index is small and would be one
    task, so its frames are dealt out by the ids that they hold: neighbouring frames of a file together.
    """
    tasks = -(-(index.agg(F.sum("n_tokens")).first()[0] or 0) // TASK_TOKENS)
    frames = frame_starts(index)
    if wanted is not None:
        frames = frames.where(F.exists(F.array(*map(F.lit, wanted)).cast("array<long>"),
                                       lambda d: d.between(F.coalesce("first_doc", F.lit(-(1 << 63))), F.col("last_doc"))))
    asked = None if wanted is None else set(wanted)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, name = None, None
        for batch in batches:
            for file, frame, start in zip(*(c.to_pylist() for c in batch.columns)):
                if file != name:
                    reader, name = FrameReader(folder, file), file
                docs, counts, ids = reader.frame(frame)
                ends = np.cumsum(counts)
                rows = [(d, start + int(e - n), int(n), zlib.crc32(ids[e - n:e].tobytes()))
                        for d, n, e in zip(docs, counts, ends) if asked is None or d in asked]
                if rows:
                    yield arrow(DOCS, **dict(zip(("doc_id", "start", "n_tokens", "ids_crc32"), zip(*rows))))

    dealt = frames.select("file", "frame", "start").repartition(max(1, int(tasks)), "file", F.floor(F.col("frame") / 4))
    return dealt.sortWithinPartitions("file", "frame").mapInArrow(handing_back(read), DOCS)


def token_files(docs: DataFrame, tokenizer: str, end_id: int = 1, folder: str | None = None,
                key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the files, then read every document back from them."""
    folder = folder or scratch_path(docs.sparkSession, "token-files")
    return read_tokens(write_tokens(docs, folder, tokenizer, end_id, key, text), folder)
