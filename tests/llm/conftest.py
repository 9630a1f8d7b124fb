import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def tables(spark):
    """doc_id -> text of the small documents table, read once."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}


LONG = "word " * 3000 + "end of a very long text without a repeated tail " + "x" * 5000


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows and clashing column names."""
    rows = [(1, "", "en"), (2, None, None), (3, LONG, "en"), (4, LONG, "en"), (4, LONG, "en"), (None, "no id here at all", None),
            (5, "one", "x"), (6, "one", "x"), (7, " \t\n ", "x"), (8, "two words", "x"), (9, "two words", "x"), (None, None, None),
            (10, "\x00 odd     \U0001f600 é あ", "x")]
    return spark.createDataFrame([(a, b, c, "k", 1, "w", 0, 2, "b") for a, b, c in rows],
                                 "doc_id long, text string, lang string, key string, n long, name string, size int, h int, blob string")
