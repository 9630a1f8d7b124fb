"""Stages of the corpus pipeline: each takes (spark, docs, sf_dir) and returns documents."""

from __future__ import annotations

from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import bpe, decontaminate, ngram_join, secret_scan
from tidewater.llm.common import handing_back, spans_of_rows, stored, table
from tidewater.llm.quality_rules import Bands, passes
from tidewater.llm.secret_scan import redact

#: What a secret becomes in a text.
MARK = "[secret]"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, all columns as they are, in one pass.

    Each row is judged by itself: repeated rows share a verdict, a null key changes nothing, null and empty texts fail the base
    rule and go.  No rows give none.
    """
    bands, at = Bands(), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in spans_of_rows(batch, "text"):
                yield part.filter(pa.array([passes(x or "", bands) for x in part.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(handing_back(run), docs.schema)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the smallest doc_id.

    Five-word shingles, similarity 0.8.  Rows of one doc_id stay or go
    together; a null doc_id belongs to no group and stays.
    """
    found = ngram_join.jaccard_components(docs, 5, ngram_join.Threshold(80, 100))
    # a row of the result is gone if a smaller doc_id is in its group; the others need no join
    gone = stored(found.where("component_id != doc_id").select("doc_id").distinct(), "near-duplicates")
    return docs.join(gone.hint("merge"), "doc_id", "left_anti").select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark.

    Null and empty texts stay.  Rows of one doc_id go together if one of them has a passage, and so do all rows with a
    null doc_id.  No rows give none.
    """
    hits = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark"))
    hit = hits.select("doc_id").distinct().withColumnRenamed("doc_id", "hit_id")
    return docs.join(hit.hint("merge"), docs["doc_id"].eqNullSafe(hit["hit_id"]), "left_anti").select(docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; found secrets are replaced in text and n_chars follows it.

    Repeated rows are rewritten alike, whatever their doc_id; a null text stays null, an empty one empty.  No rows give none.
    """
    found = secret_scan.scan_history(docs.select("doc_id", "text"))
    mark = MARK
    # few documents have secrets: their texts alone are rewritten and joined back by content address
    spans = found.where(F.size("found") > 0).groupBy("blob").agg(
        F.any_value(F.transform("found", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))).alias("found"),
        F.any_value("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in spans_of_rows(batch, "text"):
                texts = [redact(x, [(s["start"], s["end"]) for s in f], mark)
                         for x, f in zip(part.column(2).to_pylist(), part.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], ["blob", "clean"])

    clean = stored(spans.select("blob", "found", "text").mapInArrow(handing_back(run), "blob string, clean string"), "redacted")
    joined = docs.withColumn("blob", secret_scan.blob_id("text")).join(clean.hint("merge"), "blob", "left")
    changed = F.col("clean").isNotNull()
    out = {"text": F.coalesce("clean", "text")}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(changed, F.length("clean").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return joined.withColumns(out).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the documents that are left, a row for each.

    A null or empty text has no tokens; repeated rows and null doc_ids each give a row; no rows give none.
    """
    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
