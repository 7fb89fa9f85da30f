"""Top n by dot product: what a known bar closes is not ranked, rounding changes no list, tasks are dealt evenly."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.operators import blocks, topdot
from tests.test_similarity import vectors


def brute(users, items, ids, n, least):
    out = []
    for u, vec in enumerate(users.astype(float)):
        s = (items.astype(float) * vec).sum(axis=1)
        out += [(u, int(j), s[j]) for j in np.lexsort((ids, -s))[:n] if least is None or s[j] > least]
    return out


def test_blocks_below_the_bars_are_not_ranked(monkeypatch):
    rng = np.random.default_rng(1)
    users, items, ids = rng.normal(size=(300, 50)).astype("float32"), rng.normal(size=(4000, 50)).astype("float32"), np.arange(4000)
    want = brute(users, items, ids, 10, 0.0)
    bars = np.array([s for _, _, s in want]).reshape(300, 10)[:, -1]
    monkeypatch.setattr(np, "partition", lambda *a, **k: pytest.fail("ranked the scores of a block that bars close"))
    got = [x for r, c, s in topdot.best_rows(users, bars, items, ids, 10, 0.0) for x in zip(r.tolist(), c.tolist(), s.tolist())]
    assert got == want


@pytest.mark.parametrize("scale", [1.0, 1e-30, 1e30, 1e120])
@pytest.mark.parametrize("least", [0.0, None])
def test_scores_that_single_precision_cannot_tell_apart(scale, least):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(40, 6))
    items = np.repeat(base, 25, axis=0) * (1 + 1e-12 * rng.integers(0, 9, size=(1000, 1)))       # differences of 1e-12 and ties
    users, ids = rng.normal(size=(60, 6)), rng.permutation(1000)
    users[7], items[5] = 0.0, 0.0
    users, items = users * scale, items * scale
    bars = np.full(60, 0.0 if least == 0.0 else -np.inf)
    for block in (np.zeros(1000, int), np.arange(1000) // 90):
        order = np.lexsort((ids, -np.sqrt((items ** 2).sum(axis=1))))
        r, m, s = topdot.best_of_run(users, bars, items[order], ids[order], block, 10, least)
        got = {}
        for u, k, x in zip(r.tolist(), m.tolist(), s.tolist()):
            got.setdefault(u, []).append((-x, k))
        for u in range(60):
            x = (items * users[u]).sum(axis=1)
            want = [(-x[j], int(ids[j])) for j in np.lexsort((ids, -x))[:10] if least is None or x[j] > least]
            assert sorted(got.get(u, [])) == want, (u, scale, least)


@pytest.mark.parametrize("most", [4096, 3])
def test_each_run_and_block_of_users_is_a_task(spark, monkeypatch, most):
    rng = np.random.default_rng(6)
    items, users = rng.normal(size=(2000, 6)), rng.normal(size=(150, 6))
    monkeypatch.setattr(blocks, "MAX_TASKS", most)
    work = {}
    top = topdot.top_by_dot(vectors(spark, users, "uid"), vectors(spark, items), 10, 0.0, item_rows=200, user_rows=20, work=work)
    plan = topdot.top_by_dot(vectors(spark, users, "uid"), vectors(spark, items), 10, 0.0, user_rows=20)._jdf.queryExecution().analyzed().toString()
    assert "MapInArrow" in plan and "FlatMapGroups" not in plan         # not as many tasks as a hash happens to give
    assert work["scored"] < work["all"] and work["sent"] <= 150 * 10
    got = {(r.uid, r["rank"]): (r.mid, r.score) for r in top.collect()}
    ranks = {}
    for u, j, s in brute(users, items, np.arange(2000), 10, 0.0):
        ranks[u] = ranks.get(u, 0) + 1
        assert got.pop((u, ranks[u])) == (j, s)
    assert not got


def test_norms_that_close_nothing_take_one_more_round(spark):
    rng = np.random.default_rng(3)
    items, users = rng.normal(size=(1600, 40)), rng.normal(size=(50, 40))
    unit = lambda m: m / np.sqrt((m * m).sum(axis=1))[:, None]
    jobs = []
    frame = type(spark.range(0))
    held, frame.checkpoint = frame.checkpoint, lambda self, *a, **k: jobs.append(1) or held(self, *a, **k)
    try:
        top = topdot.top_by_dot(vectors(spark, unit(users), "uid"), vectors(spark, unit(items)), 3, 0.0, item_rows=20)
    finally:
        frame.checkpoint = held
    assert len(jobs) == 2                       # the items and the first round: 80 blocks would be four rounds
    want = brute(unit(users), unit(items), np.arange(1600), 3, 0.0)
    assert sorted((r.uid, r.mid) for r in top.select("uid", F.col("mid")).collect()) == sorted((u, j) for u, j, _ in want)


def test_a_null_key_is_the_lowest_int(spark):
    items = vectors(spark, np.eye(3) + 1)
    users = spark.createDataFrame([(None, [1.0, 0.0, 0.0]), (4, [0.0, 1.0, 0.0])], "uid int, features array<double>")
    got = sorted((r.uid, r["rank"], r.mid) for r in topdot.top_by_dot(users, items, 1).collect())
    assert got == [(-2 ** 31, 1, 0), (4, 1, 1)]
