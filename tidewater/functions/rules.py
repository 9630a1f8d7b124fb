"""Validation rules as Column expressions."""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewater.schemas import CORRUPT_COL, ORDERS, PAYMENTS

# fixed values: currencies a payment may carry
PAYMENT_CURRENCIES = ("BRL", "USD", "EUR", "GBP")


def as_of_col(as_of=None) -> Column:
    """``as_of`` as a zone-free timestamp; ``None`` means the session clock."""
    if as_of is None:
        return F.localtimestamp()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, _dt.datetime):
        as_of = as_of.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(str(as_of)).cast("timestamp_ntz")


def rules_for(service: str, as_of=None, columns: list[str] | None = None) -> list[tuple[str, Column]]:
    """Ordered (rule name, predicate) pairs for one service.

    A predicate may evaluate to NULL (e.g. NULL amount); callers treat NULL as
    a failure so valid + invalid always equals the row count.
    """
    # fixed values: the rule names
    rules = [
        ("not_null_event_id", F.col("event_id").isNotNull()),
        ("not_null_timestamp", F.col("timestamp").isNotNull()),
        ("valid_timestamp", F.col("timestamp") <= as_of_col(as_of)),
        ("not_empty_event_type", F.col("event_type").isNotNull() & (F.col("event_type") != F.lit(""))),
    ]
    if service == PAYMENTS:
        rules.append(("positive_amount", F.col("amount") > F.lit(0)))
        rules.append(("valid_currency", F.col("currency").isin(*PAYMENT_CURRENCIES)))
    elif service == ORDERS:
        rules.append(("positive_amount", F.col("total_amount") >= F.lit(0)))
    if columns is not None and CORRUPT_COL in columns:
        rules.append(("well_formed_record", F.col(CORRUPT_COL).isNull()))
    return rules


def passes(rule: Column) -> Column:
    """Two-valued outcome of a rule: NULL counts as failed."""
    return F.coalesce(rule, F.lit(False))


def all_pass(rules: list[tuple[str, Column]]) -> Column:
    return reduce(lambda a, b: a & b, [passes(r) for _, r in rules], F.lit(True))


def failed_rule_names(rules: list[tuple[str, Column]]) -> Column:
    """Array of the names of the rules a row fails (empty when valid)."""
    return F.array_compact(F.array(*[F.when(~passes(r), F.lit(n)) for n, r in rules]))
