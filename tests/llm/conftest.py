import random

import pytest
from hypothesis import settings

settings.register_profile("steady", deadline=None)
settings.load_profile("steady")

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, key long, score double, n_words long, ids string"


@pytest.fixture(scope="session")
def frame(spark):
    """Documents with extra columns whose names the operators use themselves."""

    def make(*rows):
        return spark.createDataFrame([(i, t, "en", "src0", 0, 1, 2, 0.5, 3, "x") for i, t in rows], SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd(frame):
    """Nulls, empty and very long texts, ties, repeated rows."""
    rng = random.Random(3)
    words = ["alpha", "Beta,", "gamma.", "délta", "日本", "x1"]
    long = " ".join(rng.choice(words) + str(rng.randrange(9999)) for _ in range(30_000))
    rows = [(1, "one two three"), (1, "one two three"), (1, "another text"), (None, "no id"), (None, None), (2, None), (3, ""), (4, " \t\n"), (5, long), (6, "a" * 5000)]
    return frame(*rows), rows


@pytest.fixture(scope="session")
def nothing(frame):
    return frame((1, "x")).filter("doc_id > 1")


@pytest.fixture(scope="session")
def corpus(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
