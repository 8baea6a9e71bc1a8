import os

import pytest

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row_id string, digest int, node int, size int, h string, s string, rules int, host string"


@pytest.fixture(scope="session")
def data():
    if not os.path.isdir(DATA):
        pytest.skip("needs the driver's tables")
    return DATA


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, ties and clashing column names."""
    extra = ("x", 1, 2, 3, "y", "z", 4, "w")
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    rows = [
        (1, "the same text here for all of us", "en", "a", 5), (2, "the  same\ttext here for all of us", "en", "a", 5), (2, "the  same\ttext here for all of us", "en", "a", 5),
        (3, None, None, None, None), (4, "", "en", None, 0), (5, "   \n", "de", "b", 4), (None, "a text without an id", "en", "b", 1), (None, None, None, None, None),
        (6, long, "en", "b", len(long)), (7, long + " more", "en", "c", len(long) + 5), (8, "été œuvre ÀÉ <|endoftext|> ok", "fr", "c", 9), (9, "x" * 300_000, "de", "c", 300_000), (10, "one", "en", "a", 3),
    ]
    return spark.createDataFrame([(*r, *extra) for r in rows], SCHEMA)
