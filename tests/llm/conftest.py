import random

import pytest


@pytest.fixture(scope="session")
def words():
    return ["alpha", "Beta", "gamma", "délta", "epsilon", "zeta", "eta", "theta", "iota", "kappa", "lambda", "mu", "nu", "xi", "omicron"]


@pytest.fixture()
def odd_docs(spark, words):
    """Nulls, empty and long texts, ties, repeated rows and columns with names the operators use themselves."""
    rng = random.Random(3)
    make = lambda n: " ".join(rng.choice(words) + str(rng.randrange(40)) for _ in range(n))
    base, long = make(120), make(30_000)
    texts = [
        (1, base), (2, base), (3, base + " end"), (4, None), (5, ""), (6, " \t\n"), (7, long), (8, long), (9, long + "x"), (10, make(3)),
        (11, "日本語 " * 5000), (12, "日本語 " * 5000), (13, make(5)), (None, base), (14, make(200)), (14, "same id"), (15, None), (16, "a"),
        (10, None), (17, make(300)), (17, make(300)),
    ]
    texts += [texts[0], texts[0], (17, texts[-1][1])]
    rows = [(i, t, "en", f"src{(i or 0) % 3}" if i != 16 else None, None, 1, "x", 2, 3, 4, "t", "b", 5) for i, t in texts]
    return spark.createDataFrame(
        rows,
        "doc_id long, text string, lang string, source string, n_chars long, row long, doc string, n int, name long, fp long, t string,"
        " block string, size int",
    ).repartition(3)


@pytest.fixture()
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
