"""Hot groups whose members are near but do not all link: what tasks emit, and the components."""

import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from marquee.llm import jaccard, shingles
from marquee.llm.common import Scratch


def rows_of(texts, k=4):
    h = [shingles.shingles(t, k) for t in texts]
    n = len(texts)
    both = lambda x: np.concatenate((x, x))
    return pd.DataFrame({"side": np.repeat([0, 1], n), "row": both(np.arange(n)), "component": both(np.arange(n)),
                         "n": both([len(x) for x in h]), "sketch": both(np.array([jaccard.bit_sketch(x) for x in h], object)),
                         "t": both(np.array(texts, object))})


def near_copies(n, lo, hi, seed):
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(200)]
    out = []
    for _ in range(n):
        w = list(base)
        for at in rng.sample(range(200), rng.randrange(lo, hi)):
            w[at] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_a_task_emits_no_more_pairs_than_rows():
    texts = near_copies(80, 3, 7, 1)
    pdf = rows_of(texts)
    assert 1 <= len(jaccard._compare(85, 100)(None, pdf)) < len(texts)
    got = jaccard._linking(4, 85, 100)(None, pdf)
    assert len(got) < len(texts)
    sets = [shingles.exact_shingles(t, 4) for t in texts]
    assert all(100 * len(sets[u] & sets[v]) >= 85 * len(sets[u] | sets[v]) for u, v in got.itertuples(index=False))


def test_components_of_near_copies_that_hardly_link(spark, monkeypatch):
    texts = near_copies(60, 2, 9, 5) + near_copies(30, 5, 7, 6)
    sets = [shingles.exact_shingles(t, 4) for t in texts]
    up = list(range(len(texts)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in up[:]:
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    want = {i: root(i) for i in range(len(texts))}
    assert 3 < len(set(want.values())) < len(texts) - 3
    monkeypatch.setattr(jaccard, "TEXT_BLOCK", 16)
    with Scratch(spark, "t") as s:
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
        stored, res, row = jaccard.near_duplicates(df, s, k=4, num=85, den=100)
        ids = stored.select(F.col(row).alias("row"), "doc_id")
        assert {r["doc_id"]: r["component_id"] for r in ids.join(res, "row").collect()} == want
