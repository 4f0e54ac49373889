import random

import pytest
from pyspark.sql import types as T

CLASHING = ["part", "stop", "Whole", "begun", "_id", "_hash", "_found", "_has", "news", "_ratios", "_place", "kept", "target"]
DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use themselves
        T.StructField("size", T.StringType()),
        T.StructField("leaks", T.StringType()),
        T.StructField("llr", T.StringType()),
        T.StructField("n", T.StringType()),
        T.StructField("u", T.StringType()),
        *[T.StructField(name, T.StringType()) for name in CLASHING],
    ]
)


@pytest.fixture
def table(spark):
    """A documents table from (doc_id, text) or (doc_id, text, source), with clashing extra columns."""

    def make(rows, parts=3):
        full = [
            (r[0], r[1], "en", r[2] if len(r) > 2 else f"s{(r[0] or 0) % 3}", len(r[1] or ""), "a", "b", "c", "d", None, *CLASHING)
            for r in rows
        ]
        return spark.createDataFrame(full, DOCS).repartition(parts)

    return make


@pytest.fixture
def clashing():
    """Names of extra columns, whose values are the names."""
    return CLASHING


@pytest.fixture
def prose():
    """Seeded invented prose of n words."""
    rng = random.Random(11)
    syllables = ["an", "er", "the", "on", "ti", "re", "ed", "nd", "ha", "es", "or", "is", "it", "ou", "ing"]

    def make(n):
        return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(n))

    return make


@pytest.fixture
def odd_rows(prose):
    """NULL ids and texts, empty and blank texts, repeated rows, one long text."""
    long = prose(30_000)
    same = prose(60)
    return [(None, None), (None, same), (1, None), (2, ""), (3, " \t\n "), (4, same), (4, same), (5, same), (6, long), (7, "one")]
