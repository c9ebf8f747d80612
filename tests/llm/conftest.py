import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node long, k1 long, ids string, score double, part int, size string, row long, at long"


def rows(texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    return [(i, t, None if k % 5 == 4 else "en", None if k % 7 == 3 else f"src{k % 3}", None, 1, 2, "x", 0.5, 3, "s", 9, 8) for k, (i, t) in enumerate(zip(ids, texts, strict=True))]


def words(n, seed, vocabulary=400):
    r = random.Random(seed)
    return " ".join(r.choice(["w", "é", "ab"]) + str(r.randrange(vocabulary)) for _ in range(n))


EDGE_TEXTS = [None, "", " ", "\n\n", "one", "two words", "Same text here twice over and over", "Same text here twice over and over", "ünï 🎉 <|endoftext|> <|startoftext|>", words(3000, 1), words(3000, 1), "a" * 5000, "tab\tand\x1cothers\x85"]
#: ids with a null and a repeated one; the repeated one comes with the same text.
EDGE_IDS = [0, 1, 2, 3, None, 5, 6, 7, 8, 9, 9, 11, 12]


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns named like the operators' own."""
    return spark.createDataFrame(rows(EDGE_TEXTS, EDGE_IDS), SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def make(spark):
    return lambda texts, ids=None, parts=3: spark.createDataFrame(rows(texts, ids), SCHEMA).repartition(parts)
