import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, row_key long, bucket_ int, shard int, places string"


def rows(texts, ids=None, lang="en", source=lambda i: f"s{i % 3}"):
    ids = range(len(texts)) if ids is None else ids
    return [(i, t, lang, source(k), len(t or ""), "x", 1, 2, 3, "y") for k, (i, t) in enumerate(zip(ids, texts, strict=True))]


def words(rng: random.Random, n: int, vocabulary: int = 500) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="session")
def frame(spark):
    """Documents with further columns whose names clash with those that operators use."""
    return lambda *a, **k: spark.createDataFrame(rows(*a, **k), SCHEMA)


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty, blank and very long texts, ties and repeated rows."""
    long = " ".join(f"t{i % 7919}" for i in range(60_000))
    data = rows([None, "", "  \n\t ", "one", "a b c d e f", "a b c d e f", long, long, "x\n" * 9, None], [1, 2, 3, 4, 5, 5, 6, 7, None, None])
    return spark.createDataFrame([*data, data[4], (8, "a b c d e f", None, None, None, None, None, None, None, None)], SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
