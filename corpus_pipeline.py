"""The corpus pipeline: stages over ``documents``, each written as Parquet and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewater.llm import stages
from tidewater.llm.common import stored, table

STAGES = [
    ("quality_rules", stages.quality),
    ("ngram_jaccard_join", stages.near_duplicates),
    ("decontamination", stages.drop_contaminated),
    ("secret_scan", stages.redact_secrets),
    ("byte_bpe", stages.encode),
]

#: SQL can express neither the compression ratios nor the BPE merges; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
