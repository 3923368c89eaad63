import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, start long, size string, n int, s string, k long, doc long, kind string, component string"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text[, source]), with columns whose names the operators use themselves."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1] or ""), 1, "x", 2, "y", 3, 4, "z", "c") for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(3)

    return make


@pytest.fixture(scope="session")
def prose():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdeéñß") for _ in range(rng.randint(1, 9))) for _ in range(4000)]

    def text(n, seed):
        own = random.Random(seed)
        return " ".join(own.choice(vocabulary) for _ in range(n))

    return text


@pytest.fixture(scope="session")
def odd_docs(make_docs, prose):
    """Nulls, empty, blank, tiny, very long, repeated rows and repeated ids."""
    long = prose(30_000, 1)
    return make_docs([
        (1, None), (2, ""), (3, "  \n\t "), (4, "word"), (5, long), (6, long), (7, "x" * 5000), (7, "x" * 5000), (8, prose(40, 2), None),
        (8, prose(50, 3)), (None, prose(40, 4)), (None, None), (9, "　é <|im_end|> \U0001f600 " * 3, "b"),
    ])
