import numpy as np
import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, kept string, length string, _gone int"
EXTRA = (1.5, "x", "y", 7)


@pytest.fixture(scope="session")
def make(spark):
    """Documents with extra columns whose names clash with those of the operators."""

    def build(rows):
        return spark.createDataFrame([(i, t, "en" if i is None or i % 2 else None, f"s{(i or 0) % 3}", None, *EXTRA) for i, t in rows], SCHEMA)

    return build


@pytest.fixture(scope="session")
def words():
    rng = np.random.default_rng(5)
    pool = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(2, 10))) for _ in range(4000)]
    return lambda n, seed: " ".join(np.random.default_rng(seed).choice(pool, n).tolist())


@pytest.fixture(scope="session")
def odd(words):
    """Null and empty texts, white space only, a very long text, non-ASCII, ties, repeated rows and rows without id."""
    long = words(30_000, 1)
    return [
        (1, None), (2, ""), (3, " \t\n"), (4, long), (5, "Ünïcödé ÀÉ \U0001f600 text\nline"), (6, "same text"), (7, "SAME text"),
        (8, "same text"), (8, "same text"), (None, "same text"), (None, None), (9, "one"), (10, "<|endoftext|> a  b"), (11, words(80, 2)),
    ]


def collected(df, *order):
    return [tuple(r) for r in df.orderBy(*[F.col(c).asc_nulls_first() for c in order]).collect()]
