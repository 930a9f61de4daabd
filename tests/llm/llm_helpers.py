"""Texts and tables for the tests of this folder."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])


def prose(seed: int, n: int, vocabulary: int = 5000) -> str:
    """``n`` made-up words that only the seed decides."""
    state, words = seed * 2654435761 + 12345, []
    for _ in range(n):
        state = (state * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        words.append(f"w{(state >> 33) % vocabulary}")
    return " ".join(words)


def odd_rows():
    """Nulls in every column, empty and blank texts, ties, repeats and a very long text."""
    base = prose(1, 120)
    return [
        (1, base, "a"), (2, base, None), (2, base, None), (3, base + " end", "b"), (None, base, "a"),
        (4, None, "b"), (5, "", "b"), (6, " \t\n", None), (7, "one", "a"), (8, "one", "a"),
        (9, "One two", "c"), (10, prose(2, 20000, 50000), "c"), (11, "ä ö ü ß é", "ü"), (None, None, None),
        (12, "\U0001f600 \U0001f600", "b"),
    ]


@pytest.fixture(scope="session")
def stored(spark, tmp_path_factory):
    """Write rows (doc_id, text, source) as a table in several files and read it back."""

    def store(rows, files: int = 3):
        path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
        full = [(i, t, "en", s, len(t) if t is not None else None) for i, t, s in rows]
        spark.createDataFrame(full, DOCS).coalesce(files).write.parquet(path)
        return spark.read.schema(DOCS).parquet(path)

    return store
