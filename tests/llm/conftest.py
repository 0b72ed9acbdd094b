import random

import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, label string, score double, "
          "bucket int, kept string, copy long, length long, node long, keys string, rate double")


def prose(rng, n, words=400):
    return " ".join(rng.choice(VOCABULARY[:words]) for _ in range(n))


_rng = random.Random(7)
VOCABULARY = ["".join(_rng.choice(["the", "on", "er", "ing", "an", "st", "ré", "ñ", "ea"]) for _ in range(_rng.randint(1, 4)))
              for _ in range(400)]


def messy_rows():
    """Nulls in every column, empty and long texts, ties, repeated rows."""
    rng = random.Random(3)
    shared = prose(rng, 30)
    texts = [None, "", " ", "\n", "one", "a b c", "A B C", "ßé ñ", "\x00 ퟿", shared, shared, shared + "\n" + shared,
             prose(rng, 9000), "x" * 5000, "\n".join([shared] * 5), "\t\r\n" * 40]
    texts += [prose(rng, rng.randint(1, 200)) + "\n" + shared for _ in range(12)]
    rows = [(i, t, ["en", "de", None][i % 3], ["a", "a", "a", "b", None][i % 5], None if t is None else len(t))
            for i, t in enumerate(texts)]
    rows += [rows[9], rows[9], (9, "another text under the same id", "en", "a", 3), (None, shared, None, None, None),
             (None, None, None, None, None), (2 ** 62, "far away", "en", "b", 8), (-5, "below zero " * 30, "fr", "c", 1)]
    return [(*r, "extra", 0.5, 1, "yes", 4, 5, 6, "k", 2.0) for r in rows]


@pytest.fixture(scope="session")
def messy(spark):
    return spark.createDataFrame(messy_rows(), SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r["doc_id"]: r["text"] or "" for r in documents.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def generator():
    return random.Random(11), prose
