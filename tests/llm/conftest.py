import random

import pytest

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture
def odd(spark):
    """Nulls, empty and long texts, repeated rows and ids, and columns with names that the operators use themselves."""
    rows = [(1, "one two three four"), (1, "one two three four"), (1, "other"), (2, None), (3, ""), (None, "x y z"), (None, None), (4, " \n\t"), (5, "word " * 50_000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("body", "digest", "fp", "ids", "row", "chunk", "core", "label", "words", "block", "key"):
        frame = frame.selectExpr("*", f"'taken' as {name}")
    return frame


@pytest.fixture
def empty(odd):
    return odd.limit(0)


@pytest.fixture
def prose():
    """Random words, the same for a seed."""

    def make(count, seed=0, words=None):
        source = random.Random(seed)
        words = words or ["".join(source.choice("abcdefgh") for _ in range(source.randint(1, 8))) for _ in range(400)]
        return " ".join(source.choice(words) for _ in range(count))

    return make
