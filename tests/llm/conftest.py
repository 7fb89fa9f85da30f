import random

import pytest

from pyspark.sql import functions as F

WORDS = "the of and to in tion ing ered shon thiti alpha beta gamma delta Émile größe été 東京 x1 42".split()


def prose(rng, n, words=WORDS):
    return " ".join(rng.choice(words) + (rng.choice(["", "", ".", ",", "\n"]) if rng.random() < 0.2 else "") for _ in range(n))


@pytest.fixture(scope="session")
def nasty():
    """(doc_id, text): nulls, empty and very long texts, ties, repeats, copies and near copies."""
    rng = random.Random(5)
    base = prose(rng, 400)
    near = base.split(" ")
    rows = [(1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "one two three"), (6, base), (7, base), (7, base),
            (8, base + " tail of a copy"), (None, base), (None, "no id"), (9, "a" * 5000), (10, "ab " * 900),
            (11, prose(rng, 9000)), (12, "!!! ### $$$ " * 40), (13, "été 東京 x\x1cy"), (4, "one")]
    for i in range(60):
        w = list(near)
        for _ in range(rng.choice([1, 4, 12])):
            w[rng.randrange(len(w))] = f"edit{i}"
        rows.append((100 + i, " ".join(w)))
    for i in range(40):
        rows.append((200 + i, prose(rng, rng.randrange(5, 60)) + " " + " ".join(near[:120]) + " " + prose(rng, 30)))
    for i in range(30):
        rows.append((300 + i, prose(rng, rng.randrange(1, 14), WORDS[:4])))
    return rows


@pytest.fixture(scope="session")
def nasty_df(spark, nasty):
    """The same with columns whose names clash with what operators make or use."""
    df = spark.createDataFrame(nasty, "doc_id long, text string")
    for c in ("row", "row_number", "score", "n_words", "spans", "component", "u", "k", "label", "t"):
        df = df.withColumn(c, F.lit("mine"))
    return df.repartition(5)


@pytest.fixture(scope="session")
def empty_df(nasty_df):
    return nasty_df.limit(0)
