import pytest

AWKWARD = [
    (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi", "en", "a", 1, "x", "y"),
    (1, "another text with the same id as the first one and some more words in it", "en", "a", 1, "x", "y"),
    (2, None, None, None, None, None, None),
    (3, "", "en", "b", 0, "", ""),
    (None, "a row without any id but with words that nobody else has written", "de", "b", 5, "x", None),
    (None, None, None, "b", None, None, None),
    (4, "same row twice over and over again", "fr", "a", 3, "k", "k"),
    (4, "same row twice over and over again", "fr", "a", 3, "k", "k"),
    (5, "wort " * 40_000, "de", "c", 9, "l", "l"),
    (6, "Licensed under the Apache License, Version 2.0.\nÄß ü 漢字 🎉", "en", "c", 9, "l", "l"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, shard string, `row` string"


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, and extra columns named like helper columns."""
    return spark.createDataFrame(AWKWARD, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
