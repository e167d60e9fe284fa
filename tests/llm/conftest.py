import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture()
def frame(spark):
    """Documents from texts, or from (id, text) pairs."""

    def make(rows):
        rows = [(k, r) if not isinstance(r, tuple) else r for k, r in enumerate(rows)]
        return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)

    return make


@pytest.fixture(scope="session")
def words():
    rng = random.Random(5)
    return lambda n: " ".join("".join(rng.choices("abcdefghij", k=rng.randint(3, 8))) for _ in range(n))
