import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, digest string, rank int, best long, "
          "kept boolean, label long, m long, chunk long, h long, no long, part long, k1 long, kept_id long, spans string")


def extend(rows):
    """Rows of documents with extra columns whose names the operators use themselves."""
    return [(i, t, "en", s, len(t or ""), "x", 1, 2, True, 3, 4, 5, 6, 7, 8, 9, 10, "y") for i, t, s in rows]


def words(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(1, 6))) for _ in range(n))


ROWS = [
    (1, "The cat sat on the mat", "a"), (2, None, "a"), (3, "", "b"), (4, "THE CAT sat on the mat", "b"),
    (5, words(5, 9000), "a"), (None, "a text without an id", None), (7, "again and again", "a"), (7, "again and again", "a"),
    (8, " \t\n ", None), (9, words(9, 60), "b"), (10, words(9, 60) + " tail", "b"), (11, words(9, 60).upper(), "c"),
    (12, words(5, 200) + "\n" + words(12, 30), "c"), (13, "x" * 20000, "c"), (14, "word", "c"), (15, "word", "a"),
    (16, "Mail é.x@b.org, or +1 (743) 555-3824; 10.0.0.1 and 4111 1111 1111 1111.", "a"), (17, words(17, 400), None),
]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(extend(ROWS), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(1, 1, 0), (4, 1, 0), (5, 1, 0), (7, 0, 0), (7, 1, 0), (9, 1, 0), (13, 0, 0), (14, 0, 1), (16, None, 0), (None, 0, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
