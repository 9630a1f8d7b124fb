"""Row validation, quarantine split and quality metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.rules import all_pass, failed_rule_names, rules_for

VALID_COL = "_is_valid"
FAILED_COL = "_failed_rules"

# fixed values: validity rate a service needs to pass the quality gate
QUALITY_THRESHOLD = 0.95


def flag_valid(df: DataFrame, service: str, as_of=None, with_failures: bool = False) -> DataFrame:
    """Add ``_is_valid`` (never NULL) and optionally ``_failed_rules``."""
    rules = rules_for(service, as_of, df.columns)
    out = df.withColumn(VALID_COL, all_pass(rules))
    if with_failures:
        out = out.withColumn(FAILED_COL, failed_rule_names(rules))
    return out


def split_valid(df: DataFrame, service: str, as_of=None,
                stamp_col: bool = True) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) rows of one service, each tagged with ``_service``.

    Both sides are filters over one flagged plan; valid + invalid = total.
    """
    flagged = flag_valid(df, service, as_of).withColumn("_service", F.lit(service))
    valid = flagged.filter(F.col(VALID_COL)).drop(VALID_COL)
    invalid = flagged.filter(~F.col(VALID_COL)).drop(VALID_COL)
    if stamp_col:
        valid = valid.withColumn("_parsed_at", F.localtimestamp())
        invalid = invalid.withColumn("_rejected_at", F.localtimestamp())
    return valid, invalid


def quality_metrics(flagged: DataFrame, service_col: str = "_service") -> DataFrame:
    """One pass per service: total, valid, invalid, validity_rate (0 when empty)."""
    return (flagged.groupBy(service_col)
            .agg(F.count(F.lit(1)).alias("total_records"),
                 F.count_if(F.col(VALID_COL)).alias("valid_records"),
                 F.count_if(~F.col(VALID_COL)).alias("invalid_records"))
            .withColumn("validity_rate",
                        F.coalesce(F.try_divide(F.col("valid_records"), F.col("total_records")),
                                   F.lit(0.0))))


def quality_overall(metrics: DataFrame) -> DataFrame:
    """Totals over all services (the final report of the parse job)."""
    return (metrics.agg(F.sum("valid_records").alias("total_valid"),
                        F.sum("invalid_records").alias("total_invalid"))
            .withColumn("overall_validity_rate",
                        F.coalesce(F.try_divide(F.col("total_valid"),
                                                F.col("total_valid") + F.col("total_invalid")),
                                   F.lit(0.0))))


def quality_gate(metrics: DataFrame, threshold: float = QUALITY_THRESHOLD) -> DataFrame:
    """Pass iff a service's validity_rate reaches ``threshold``."""
    return metrics.withColumn("gate_passed", F.col("validity_rate") >= F.lit(threshold))


def rule_failures(flagged_with_failures: DataFrame, service_col: str = "_service") -> DataFrame:
    """Rows failing each rule, per service (a row failing two rules counts twice)."""
    return (flagged_with_failures
            .select(service_col, F.explode(FAILED_COL).alias("rule"))
            .groupBy(service_col, "rule")
            .agg(F.count(F.lit(1)).alias("failed_count")))
