import random

import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, ids string, n string, key string"
WORDS = "the of and river stone light under water morning glass letter window paper garden silver quiet road".split()


def prose(seed, words):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "", "s", "ing", "ed", "ly"]) for _ in range(words))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and clashing names."""
    rows = [
        (1, prose(1, 60), "en", "a", 1, "x", "y", "z", "k"),
        (1, prose(1, 60), "en", "a", 1, "x", "y", "z", "k"),
        (2, "", "en", None, 0, None, None, None, None),
        (3, None, None, "a", None, None, None, None, None),
        (None, prose(2, 30), "en", "a", 1, None, None, None, None),
        (4, "  \n\t ", "fr", "a", 1, None, None, None, None),
        (5, prose(5, 40_000), "en", "a", 1, None, None, None, None),
        (6, "1234 !!! ###", "fr", "a", 1, None, None, None, None),
        (7, prose(1, 60), None, "b", 1, None, None, None, None),
        (8, "a" * 30_000, "fr", "b", 1, None, None, None, None),
        (9, "\x00\x1c퟿\U0001f600 <|endoftext|>", "fr", "b", 1, None, None, None, None),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sf_docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
