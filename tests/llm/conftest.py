import random

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, score string, fp string, taken string"


def prose(rng, n, words=("alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa", "theta")):
    return " ".join(rng.choice(words) + str(rng.randint(0, 99)) for _ in range(n))


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in every column, empty and long texts, ties, repeated rows; the
    last three columns clash with names the operators use."""
    rng = random.Random(7)
    shared, base = prose(rng, 60), prose(rng, 120)
    rows = [
        (1, base, "en", "a"), (2, base, "en", "a"), (2, base, "en", "a"), (3, base + " tail", "en", "b"),
        (4, None, "en", "b"), (5, "", None, "c"), (6, " \t\n", "de", None), (7, "one", "de", "a"), (8, "one two three", "de", "b"),
        (9, prose(rng, 80) + "\n" + shared, "fr", "c"), (10, shared + " " + prose(rng, 90), "fr", None), (None, prose(rng, 100), "en", "d"),
        (None, None, None, None), (11, "é ü 日本語 \U0001f600 " * 40, "fr", "é"), (12, "x" * 5000, "en", "a"),
        (13, prose(rng, 6000), "en", "a"), (14, "ab " * 900, "en", "b"), (14, "other text " + prose(rng, 70), "de", "b"),
    ]
    rows += [(20 + i, prose(rng, 30 + i), ("en", "de", "fr")[i % 3], "abc"[i % 3]) for i in range(12)]
    return [(a, b, c, d, None if b is None else len(b), "s", "f", "t") for a, b, c, d in rows]


@pytest.fixture(scope="session")
def edge(spark, edge_rows):
    return spark.createDataFrame(edge_rows, COLUMNS).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)
