"""Secret scans with an incremental blob ledger.

Every version of every path is content-addressed.  The ledger holds one row per
(blob, rule, rule version) that was ever scanned, with what was found; only
pairs it lacks are scanned, and findings are joined back to all paths.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import handing_back, spans_of_rows
from tidewater.session import scratch_path


@dataclass(frozen=True)
class Rule:
    """A pattern; a match counts if ``group`` has ``least`` characters.  ``hint``: a
    lower-case string that every match holds (letters in either case)."""

    name: str
    version: int
    pattern: str
    group: int | str = 0
    least: int = 1
    hints: tuple[str, ...] = ()
    either_case: bool = False

    def finder(self) -> Callable[[str, str], list[tuple[int, int]]]:
        find = re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.either_case else 0)).finditer

        def spans(text: str, lower: str) -> list[tuple[int, int]]:
            if self.hints and not any(h in lower for h in self.hints):
                return []
            return [m.span() for m in find(text) if len(m[self.group]) >= self.least]

        return spans


#: The base kinds, in the order in which equal starts are listed.
BASE_RULES = (
    Rule("assign", 1, r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         group=2, least=6, hints=("passw", "secret", "token", "key"), either_case=True),
    Rule("access", 1, r"AKIA[A-Z0-9]+", least=20, hints=("akia",)),
    # a run shorter than 24 is no match, so asking for 24 finds the same runs
    Rule("hex", 1, r"[0-9a-f]{24,}"),
)
#: What this scan adds to the base kinds.
MORE_RULES = (
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", hints=("private key-----",)),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", hints=("eyj",)),
    Rule("github", 1, r"gh[pousr]_[A-Za-z0-9]{36,}", hints=("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
)
RULES = BASE_RULES + MORE_RULES

LEDGER = "blob string, rule string, version int, spans array<struct<start:int,end:int>>"


def blob_id(text: str = "text"):
    """Content address; a null text has that of the empty one."""
    return F.sha2(F.coalesce(F.col(text), F.lit("")), 256)


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    """The ledger, or None where nothing was written yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
    return spark.read.schema(LEDGER).parquet(path) if there else None


def scan_unseen(history: DataFrame, ledger_path: str, rules: tuple[Rule, ...] = RULES,
                text: str = "text") -> DataFrame:
    """Scan the (blob, rule version) pairs of ``history`` that the ledger lacks; returns the ledger.

    One shuffle of the texts: copies of a blob collapse in each map task, so a
    text that a third of all rows share travels once per task.  The new rows
    are appended in one Parquet write; a scan that fails leaves the ledger as
    it was, and a repeated one finds nothing left to do.
    """
    spark = history.sparkSession
    blobs = history.groupBy(blob_id(text).alias("blob")).agg(F.any_value(F.coalesce(text, F.lit(""))).alias("text"))
    known = read_ledger(spark, ledger_path)
    if known is not None:
        current = " or ".join(f"(rule = '{r.name}' and version = {r.version})" for r in rules)
        # sha256 keys: no blob is hot here, each has a row per rule
        seen = (known.where(current).groupBy("blob").agg(F.collect_set("rule").alias("seen")))
        blobs = (blobs.join(seen, "blob", "left").withColumn("seen", F.coalesce("seen", F.array().cast("array<string>")))
                 .where(F.size("seen") < len(rules)))
    else:
        blobs = blobs.withColumn("seen", F.array().cast("array<string>"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finders = [(r, r.finder()) for r in rules]
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            for part in spans_of_rows(batch, "text"):
                out = ([], [], [], [])
                for blob, x, seen in zip(*(c.to_pylist() for c in part.columns)):
                    lower = x.lower()
                    for r, find in finders:
                        if r.name not in seen:
                            row = (blob, r.name, r.version, [{"start": a, "end": b} for a, b in find(x, lower)])
                            for column, v in zip(out, row):
                                column.append(v)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int32()),
                     pa.array(out[3], kind)], ["blob", "rule", "version", "spans"])

    blobs.select("blob", "text", "seen").mapInArrow(handing_back(scan), LEDGER).write.mode("append").parquet(ledger_path)
    return spark.read.schema(LEDGER).parquet(ledger_path)


def findings(history: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """``history`` (its columns kept) with ``blob`` and ``found``: array of (start, rank, kind, end).

    ``found`` is in order of start, then of the rules.  Every path and version
    that has the blob gets it; the ledger has one row per blob and rule, so it
    is gathered per blob before the join and the many paths of one blob can be
    split by Spark.  Two scans that ran at once may both have appended a pair: its spans count once.
    """
    rank = F.element_at(F.create_map(*(F.lit(v) for i, r in enumerate(rules) for v in (f"{r.name}:{r.version}", i))),
                        F.concat_ws(":", "rule", "version"))
    per_blob = (ledger.withColumn("rank", rank).where("rank is not null").where(F.size("spans") > 0)
                .groupBy("blob").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.transform(
                    "spans", lambda s: F.struct(s["start"].alias("start"), F.col("rank").alias("rank"),
                                                F.col("rule").alias("kind"), s["end"].alias("end"))))))).alias("found")))
    return history.withColumn("blob", blob_id(text)).join(per_blob, "blob", "left")


def scan_history(history: DataFrame, ledger_path: str | None = None, rules: tuple[Rule, ...] = RULES,
                 text: str = "text") -> DataFrame:
    """Findings for every (path, version) row of ``history``.

    A null text counts as empty; rows that repeat each get their findings; an
    empty table gives no rows.  The columns of ``history`` are kept, except
    that ``blob`` and ``found`` are replaced.
    """
    path = ledger_path or scratch_path(history.sparkSession, "secret-ledger")
    history = history.drop("blob", "found")
    return findings(history, scan_unseen(history, path, rules, text), rules, text)


def span_digest(kinds: tuple[str, ...] | None = None):
    """``kind:start:end`` of the found spans, comma-joined."""
    found = F.coalesce(F.col("found"), F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>"))
    if kinds:
        found = F.filter(found, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(text: str, spans: list[tuple[int, int]], mark: str = "[secret]") -> str:
    """``text`` with each stretch of overlapping spans (code points) replaced by ``mark``."""
    out, at = [], 0
    for start, end in sorted(spans):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])

