import numpy as np
from marquee.functions.expr import cosine
from marquee.operators.factors import top_n_by_dot
from marquee.operators.similarity import item_similarity, pair_similarity, similar_lists


def vectors(spark, mat, name="mid"):
    return spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(mat)],
                                 f"{name} int, features array<double>")


def test_blocked_similarity_equals_brute_force(spark):
    rng = np.random.default_rng(7)
    mat = rng.normal(size=(120, 4))
    mat[5] = 0.0                                  # zero vector: no pairs
    got = {(r.mid, r.other_mid): r.sim
           for r in item_similarity(vectors(spark, mat), 0.6, block_rows=16).collect()}
    n = np.linalg.norm(mat, axis=1)
    want = {}
    for a in range(len(mat)):
        for b in range(len(mat)):
            if a != b and n[a] > 0 and n[b] > 0:
                s = mat[a] @ mat[b] / (n[a] * n[b])
                if s > 0.6:
                    want[(a, b)] = s
    assert set(got) == set(want)
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)
    assert all(got[(b, a)] == got[(a, b)] for a, b in got)     # both directions, equal values


def test_cosine_expression_zero_vector_is_null(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<double>, b array<double>")
    got = [r.c for r in df.select(cosine("a", "b").alias("c")).collect()]
    assert abs(got[0] - 2 ** -0.5) < 1e-12 and got[1] is None


def test_similar_lists_and_pair_lookup(spark):
    sims = spark.createDataFrame([(1, 2, 0.7), (1, 3, 0.9), (2, 1, 0.7), (3, 1, 0.9)],
                                 "mid int, other_mid int, sim double")
    nested = {r.mid: [(x.mid, x.score) for x in r.recs] for r in similar_lists(sims).collect()}
    assert nested[1] == [(3, 0.9), (2, 0.7)]
    flat = {r.mid: r.recs for r in similar_lists(sims, nested=False).collect()}
    assert flat[1] == "3:0.900000|2:0.700000"
    pairs = spark.createDataFrame([(1, 3), (2, 3)], "mid_a int, mid_b int")
    got = {(r.mid_a, r.mid_b): r.sim for r in pair_similarity(pairs, sims).collect()}
    assert got == {(1, 3): 0.9, (2, 3): 0.0}


def test_top_n_by_dot_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    users = rng.integers(-2, 3, size=(40, 3)).astype(float)     # many ties
    items = rng.integers(-2, 3, size=(70, 3)).astype(float)
    got = sorted((r.uid, r.rank, r.mid, r.score) for r in
                 top_n_by_dot(vectors(spark, users, "uid"), vectors(spark, items), 5, 0.0, block_rows=8).collect())
    want = []
    for u in range(len(users)):
        s = items @ users[u]
        cand = sorted((-s[i], i) for i in range(len(items)) if s[i] > 0)[:5]
        want += [(u, k + 1, i, -ns) for k, (ns, i) in enumerate(cand)]
    assert got == sorted(want)


def test_predict_pairs_and_top_n_per_user(spark):
    from marquee.operators.factors import predict_pairs, top_n_per_user
    users = vectors(spark, [[1.0, 0.0], [0.0, 1.0]], "uid")
    items = vectors(spark, [[2.0, 1.0], [-1.0, 3.0], [0.5, 0.5]])
    pairs = spark.createDataFrame([(0, 0), (0, 1), (0, 2), (1, 0), (1, 1), (1, 9)], "uid int, mid int")
    pred = {(r.uid, r.mid): r.prediction for r in predict_pairs(users, items, pairs).collect()}
    assert pred == {(0, 0): 2.0, (0, 1): -1.0, (0, 2): 0.5, (1, 0): 1.0, (1, 1): 3.0}
    top = [(r.uid, r.rank, r.mid) for r in top_n_per_user(predict_pairs(users, items, pairs), 1).collect()]
    assert sorted(top) == [(0, 1, 0), (1, 1, 1)]


def test_null_and_zero_vectors_have_no_pairs(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, None), (4, [0.0, 0.0]), (5, [1.0, None])],
                               "mid int, features array<double>")
    got = sorted((r.mid, r.other_mid) for r in item_similarity(df, 0.6).collect())
    assert got == [(1, 2), (2, 1)]


def test_kernels_give_same_result_in_small_chunks(monkeypatch):
    from marquee.operators import topdot
    rng = np.random.default_rng(9)
    users, items, ids = rng.normal(size=(37, 4)), rng.normal(size=(23, 4)), np.arange(100, 123)

    def run():
        return sorted(tuple(r) for out in topdot.best_rows(users, np.full(37, -np.inf), items, ids, 4, None)
                      for r in zip(*(x.tolist() for x in out)))

    whole = run()
    monkeypatch.setattr(topdot, "CHUNK_BYTES", 8 * 23 * 3)        # 3 rows per chunk
    assert run() == whole and len(whole) == 37 * 4


def test_block_layout_does_not_change_results_on_real_tables(spark):
    from marquee.sources import fixtures as fx
    sf = "/root/testdata/sf0.01"
    feats = fx.item_features(spark, sf)
    default = {(r.mid, r.other_mid): round(r.sim, 9) for r in item_similarity(feats).collect()}
    small = {(r.mid, r.other_mid): round(r.sim, 9) for r in item_similarity(feats, block_rows=37).collect()}
    assert default == small and len(default) == 10872
    users = feats.select(feats.mid.alias("uid"), "features")
    a = sorted((r.uid, r.rank, r.mid) for r in top_n_by_dot(users, feats, 10).collect())
    b = sorted((r.uid, r.rank, r.mid) for r in top_n_by_dot(users, feats, 10, block_rows=23).collect())
    assert a == b and len(a) > 0


def test_unrolled_dot_equals_generic(spark):
    from marquee.functions.expr import dot
    rng = np.random.default_rng(4)
    rows = [([float(x) for x in rng.normal(size=5)], [float(x) for x in rng.normal(size=5)]) for _ in range(50)]
    df = spark.createDataFrame(rows, "a array<double>, b array<double>")
    got = df.select(dot("a", "b").alias("g"), dot("a", "b", 5).alias("u")).collect()
    assert all(r.g == r.u for r in got)
