import random

import pytest

WORDS = "the of in and to a red fox über naïve ran saw tree house river stone light dark wind rain".split()


@pytest.fixture(scope="session")
def documents(spark):
    """Rows to (doc_id, text) with columns whose names operators use themselves."""

    def make(rows, extra=True):
        df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, run string, keep_id int")
        if not extra:
            df = df.select("doc_id", "text")
        return df.repartition(5)

    return make


@pytest.fixture(scope="session")
def prose():
    def make(seed, n, low=3, high=60):
        rng = random.Random(seed)
        return [" ".join(rng.choices(WORDS, k=rng.randint(low, high))) for _ in range(n)]

    return make
