from __future__ import annotations

import pytest

#: Odd rows every operator on documents must take: nulls, empty and long texts, repeats, ties.
ODD_ROWS = [
    (1, "one two three four five six seven eight nine ten", "en", "b", 7),
    (1, "one two three four five six seven eight nine ten", "en", "b", 7),
    (2, "one two three four five six seven eight nine ten", "en", None, 7),
    (3, None, None, None, None),
    (4, "", "en", "a", 0),
    (None, "null id with some words that stand here once only, and then no more of them", "en", "a", 3),
    (None, "", None, "a", 3),
    (5, " \n\t \n", "en", "a", 3),
    (6, "ONE two three four five six seven eight nine eleven\n\nshort line", "en", "é", 3),
    (7, "word " * 30000, "en", "a", 3),
    (8, "x" * 100000, "en", "a", 3),
    (9, "don't  stop 　 ‐ 日本語 \U0001d11e <|endoftext|> </s>\u0000▁", "xx", "a\U0001f600", 3),
    (10, "one two three four five six seven eight nine ten\nalpha beta gamma delta epsilon zeta eta theta", "en", "b", 1),
]
ODD_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    return spark.createDataFrame(ODD_ROWS, ODD_SCHEMA).cache()


@pytest.fixture(scope="session")
def clashing_docs(odd_docs):
    """The odd rows with further columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    names = ["size", "place", "block", "shards", "fp", "row_no", "frequent", "gone", "left", "n_words", "kept", "root", "row", "key"]
    return odd_docs.select("*", *(F.lit(i).alias(n) for i, n in enumerate(names)))


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], ODD_SCHEMA)
