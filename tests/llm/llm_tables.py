"""Fixtures of the training-data tests; imported by the test modules."""

import pytest

ODD_ROWS = [
    (1, None, "en", "a", None), (2, "", "en", None, 0), (3, " \t\n ", None, "a", 3), (4, "one two", "en", "b", 7),
    (5, "one two", "en", "b", 7), (6, "Same words here again and again in this text of more than ten words.", "en", "a", 60),
    (7, "Same words here again and again in this text of more than ten words.", "en", "a", 60),
    (8, "x" * 250, "en", "a", 250), (9, ("long text " * 3000) + "x" * 250, "de", "a", None), (10, "é" * 120 + " 日本", "fr", "c", 1),
    (11, "before<|endoftext|>after <|endoftext|><|endoftext|> end", "en", "a", 52),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, repeats, and extra columns with clashing names."""
    rows = [(*r, r[0], "r", 1, "x", [1], 5) for r in ODD_ROWS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "doc long, row string, n int, items string, rest array<int>, label int").repartition(3)


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
