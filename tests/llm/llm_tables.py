"""Small tables with the cases every operator has to stand."""

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
#: Null and empty texts, repeated rows, ties, a long text, null ids and names.
EDGES = [
    (1, None, "en", "a", 0),
    (2, "", "en", None, 0),
    (3, "one", None, "a", 3),
    (3, "one", None, "a", 3),
    (4, "one two three four five six", "en", "b", 27),
    (5, "One TWO three\tfour\nfive  six", "de", "b", 28),
    (None, "one two three four five seven", "en", "c", 29),
    (7, "word " * 30_000, "en", "a", 150_000),
    (8, "ÉÀ   ß \U0001f600", "fr", "\U0001f600", 8),
]


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(EDGES, COLUMNS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="session")
def few_labels(spark):
    rows = [(1, 1, 0), (3, 0, None), (4, 1, 1), (4, 1, 1), (5, None, 0), (99, 0, 1), (None, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
