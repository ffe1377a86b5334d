import os

import pytest

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, tokens string, host string, fp string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """NULLs in every column, empty and very long texts, ties, repeated rows, and columns named like results."""
    passage = " ".join(f"w{i}" for i in range(60))
    long = " ".join(f"long{i % 977}x{i}" for i in range(20_000))
    rows = [
        (1, passage, "en", "a", 1, "t", "h", "f"), (2, f"before {passage} after", "en", "a", 1, "t", "h", "f"),
        (3, passage, "en", None, 1, "t", "h", "f"), (3, passage, "en", None, 1, "t", "h", "f"),
        (None, passage, None, "a", None, None, None, None), (4, None, "en", "a", 1, "t", "h", "f"),
        (5, "", "fr", "b", 1, "t", "h", "f"), (6, long, "fr", "b", 1, "t", "h", "f"),
        (7, "short text", None, None, None, None, None, None), (7, "another text\nof two lines", "fr", "b", 1, "t", "h", "f"),
        (8, "\n\n  \t\n", "fr", "b", 1, "t", "h", "f"), (None, None, None, None, None, None, None, None),
        (9, "1234 5678 !?", "en", "b", 1, "t", "h", "f"),
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
