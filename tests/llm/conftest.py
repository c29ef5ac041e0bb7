"""Shared fixtures of the training-data operators' tests."""

import random

import pytest

from orderlake.llm.common import ship_package


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(words))


@pytest.fixture(scope="session")
def odd_rows():
    """Documents with nulls, empty, wordless, very long and repeated texts, repeated rows and ties."""
    base = prose(1, 120)
    long = prose(2, 60_000, 50_000)
    return [
        (1, base, "en", "a", 1), (2, base, "en", "a", 1), (2, base, "en", "a", 1), (3, base + " extra", "fr", "b", 1),
        (4, None, "en", "a", None), (5, "", None, None, 0), (6, " \t\n ", "en", None, 4), (None, base, "de", "c", 9),
        (None, None, None, None, None), (7, long, "en", "a", 1), (8, "one", "xx", "b", 3), (9, "ONE", "en", "c", 3),
        (10, "a b c d", "en", "c", 7), (11, "naïve Ünïcode ßtraße 東京", "de", "b", 5), (12, "... !!! 123", "en", "a", 3),
    ]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return spark.createDataFrame(odd_rows, DOC_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


CLASHING = ["_row", "_id", "_k", "_found", "_bucket", "_order", "shard", "slot", "size", "position", "epoch", "words",
            "target", "found", "host", "score", "cls", "n", "tok", "_semi_id", "_text", "_lang", "_m", "_at"]


@pytest.fixture(scope="session")
def clashing(odd_docs):
    """The odd documents with extra columns named like what operators use inside."""
    from pyspark.sql import functions as F

    return odd_docs.withColumns({c: F.lit(f"extra {c}") for c in CLASHING})


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
