import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(seed, n):
    """Words that depend on the seed alone."""
    import random

    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(40)) for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows, ties, and columns named like helpers' own."""
    long = prose(1, 30_000)
    rows = [
        (1, prose(2, 60), "a"), (2, prose(2, 60), "a"), (2, prose(2, 60), "a"), (3, prose(2, 60).replace(" ", "\t ", 3), None),
        (4, None, "b"), (5, "", None), (6, " \n\t", "b"), (None, prose(3, 40), "a"), (None, None, None), (7, long, "c"), (8, long + " end", "c"),
        (9, "é" * 50 + " x", "ç"), (10, "one", "a"), (11, "ONE", "a"), (12, "x" * 20_000, "c"),
    ]
    rows = [(*r, i, "p", i, 1, 1.0, "d") for i, r in enumerate(rows)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, _row int, _path string, n int, size int, score double, digest string")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
