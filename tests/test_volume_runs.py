"""Top lists: users are sent to runs of item blocks, not to each block."""

import numpy as np
from pyspark.sql import functions as F

from marquee.operators import topdot
from tests.test_similarity import vectors


def test_users_are_sent_to_runs_of_blocks(spark, monkeypatch):
    rng = np.random.default_rng(6)
    items, users = rng.normal(size=(2000, 6)).astype("float32"), rng.normal(size=(150, 6)).astype("float32")
    monkeypatch.setattr(topdot, "ITEM_ROWS", 50)
    work = {}
    cast = lambda d, k: vectors(spark, d.astype(float), k).withColumn("features", F.col("features").cast("array<float>"))
    top = topdot.top_by_dot(cast(users, "uid"), cast(items, "mid"), 10, None, user_rows=40, work=work).collect()
    assert work["sent"] <= 4 * 150          # 40 blocks, but a round sends a user once to a run
    got = {}
    for r in top:
        got.setdefault(r["uid"], {})[r["rank"]] = (r["mid"], r["score"])
    i64, u64 = items.astype(float), users.astype(float)
    for u in range(150):
        s = (i64 * u64[u]).sum(axis=1)
        assert got[u] == {k + 1: (int(j), s[j]) for k, j in enumerate(np.lexsort((np.arange(len(s)), -s))[:10])}
