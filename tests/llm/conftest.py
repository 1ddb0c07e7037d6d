import random

import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """Build a documents table from (doc_id, text) pairs."""

    def build(rows, **extra):
        frame = spark.createDataFrame(
            [(i, t, "en", f"s{(i or 0) % 3}", len(t) if t is not None else None) for i, t in rows],
            "doc_id bigint, text string, lang string, source string, n_chars bigint")
        return frame

    return build


def sentence(rng: random.Random, words: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{int(vocabulary * rng.random() ** 2)}" for _ in range(words))


@pytest.fixture
def rng():
    return random.Random(7)
