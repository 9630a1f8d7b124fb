"""The operators as queries over whole test tables, with their fixed results."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import (bpe, decontaminate, ngram_join, periodic_runs, quality_classifier, quality_rules, recompression,
                           secret_scan, sharding, token_alignment, token_files, tokenization_automaton, warc_revisits)
from tidewater.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


@register("op1_set_relation_join")
def op1(spark, sf_dir):
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"), 3, ngram_join.Threshold(90, 100))


@register("op2_secret_scan")
def op2(spark, sf_dir):
    history = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan_history(history)

    def n(kind):
        own = F.filter("found", lambda s: s["kind"] == kind)
        return F.coalesce(F.size(own), F.lit(0)).cast("long").alias(f"n_{kind}")

    found = found.drop("text").withColumn("found", F.coalesce("found", F.array().cast(
        "array<struct<start:int,rank:int,kind:string,end:int>>")))
    base = tuple(r.name for r in secret_scan.BASE_RULES)
    return found.select("doc_id", *(n(k) for k in base), F.sha2(secret_scan.span_digest(base), 256).alias("base_sha256"),
                        secret_scan.span_digest().alias("spans"), "blob")


@register("op3_latent_decontamination")
def op3(spark, sf_dir):
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op4_revisit_resolution", warc_revisits.ORACLE)
def op4(spark, sf_dir):
    found = warc_revisits.resolve_revisits(warc_revisits.derived_records(table(spark, sf_dir, "pages")))
    fields = F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return found.withColumns({"ts": F.col("ts").cast("long"), "headers": F.array_join(F.array_sort(fields), "\n")})


@register("op5_fourier_classifier")
def op5(spark, sf_dir):
    scored = quality_classifier.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@register("op6_token_files")
def op6(spark, sf_dir):
    return token_files.token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@register("op7_recompression")
def op7(spark, sf_dir):
    return recompression.drop_repeats(table(spark, sf_dir, "documents"))


@register("op8_compression_bands")
def op8(spark, sf_dir):
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


@register("op9_byte_bpe")
def op9(spark, sf_dir):
    return bpe.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                                public_tokenizers.PATTERN)


@register("op10_histogram_shards")
def op10(spark, sf_dir):
    return sharding.histogram_shards(table(spark, sf_dir, "documents"))


@register("op11_tokenization_automaton")
def op11(spark, sf_dir):
    coded = tokenization_automaton.code_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return tokenization_automaton.code_digests(coded)


@register("op12_token_alignment")
def op12(spark, sf_dir):
    return token_alignment.alignment_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                            public_tokenizers.path("piece_bpe_32k.model"))


@register("op13_periodic_runs")
def op13(spark, sf_dir):
    return periodic_runs.run_digests(periodic_runs.periodic_runs(periodic_runs.with_periods(table(spark, sf_dir, "documents"))))
