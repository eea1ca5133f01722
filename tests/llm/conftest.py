from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Nulls in every column, no words, ties, repeated rows, one long text.
ODD = [
    (1, None, None, None, None),
    (None, "a b c d e f g", "en", None, 3),
    (None, None, None, "s1", None),
    (2, "", "en", "s1", 0),
    (3, " \t\n ", None, "s2", 4),
    (4, "same words in the same order as before", "en", "s1", 5),
    (4, "same words in the same order as before", "en", "s1", 5),
    (5, "same words in the same order as before", "fr", "s2", 5),
    (6, "123 456 !!!", "en", "s2", 5),
    (7, "long " * 200_000 + "end", "en", "s1", 5),
    (8, "x" * 300_000, "en", "s1", 5),
]


@pytest.fixture
def odd(spark):
    """Documents that must not break anything, with extra columns whose names clash with results."""
    frame = spark.createDataFrame(ODD, SCHEMA)
    extra = "size n copies salt key host path good score words item_id component_id text_2 spans target pos"
    return frame.selectExpr("*", *[f"'extra' as {c}" for c in extra.split()])


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def sample(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
