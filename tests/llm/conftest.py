import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and
    extra columns whose names the operators use themselves."""
    rows = [(1, None, "en", "a", None), (2, "", None, None, 0), (3, "same text here.", "en", "a", 15),
            (3, "same text here.", "en", "a", 15), (4, "same text here.", "de", None, 15), (None, None, None, None, None),
            (None, "no id at all", "en", "b", 12), (5, "word " * 30_000, "en", "a", 150_000), (6, " \n\t ", "fr", "a", 4),
            (3, "another text with the same id", "en", "a", 29)]
    df = spark.createDataFrame(rows, SCHEMA)
    clashing = ["node", "shard", "doc", "row", "key", "fp", "h", "queue", "part", "ids", "k", "link", "x", "score", "label"]
    return df.selectExpr("*", *[f"'extra' AS `{c}`" for c in clashing])


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def passages():
    """(doc_id, text): passages shared by several documents, nulls and runs."""
    rng = random.Random(2)
    shared = [" ".join(rng.choice("abcdefgh") for _ in range(60)) for _ in range(6)]
    rows = []
    for i in range(120):
        text = " ".join(rng.choice(["x", "y", "z", *(f"w{j}" for j in range(50))]) for _ in range(rng.randint(0, 50)))
        for _ in range(rng.randint(0, 3)):
            b, a = rng.choice(shared).split(), rng.randint(0, 40)
            text += rng.choice([" ", "\n"]) + " ".join(b[a:a + rng.randint(1, 60)])
        kind = rng.random()
        rows.append((i, None if kind < .05 else "" if kind < .1 else "q " * rng.randint(1, 90) if kind < .2 else text))
    return rows
