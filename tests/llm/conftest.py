import pytest


@pytest.fixture
def frame(spark):
    """A documents frame from (doc_id, text) pairs, with columns whose names clash with those of operators."""
    def make(rows):
        return spark.createDataFrame([(i, x, "en", "src0", None if x is None else len(x)) for i, x in rows], "doc_id bigint, text string, kept string, h string, n_chars bigint")
    return make


def prose(seed, n):
    import random

    rng = random.Random(seed)
    return " ".join("".join(rng.choice(["the", "an", "er", "on", "in", "re", "st", "ou"]) for _ in range(rng.randint(1, 4))) for _ in range(n))
