"""Registered queries on the smallest tables: SQL where there is some, brute force and held-out accuracy elsewhere."""

import hashlib
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from marquee.llm import bpe, langid, oracle, quality, rules, sarray, tokens, toxicity
from marquee.llm.common import Scratch, fold
from marquee.llm.queries import QUERIES
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


@pytest.fixture(scope="module")
def texts(duck):
    return dict(duck.execute("SELECT doc_id, text FROM documents").fetchall())


def test_all_are_registered():
    assert {*QUERIES, "pipeline"} <= set(entry.queries())
    assert len({k.split("_")[0] for k in QUERIES}) == len(QUERIES)


@pytest.mark.parametrize("name", sorted(oracle.ORACLE))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    res = duck.execute(oracle.ORACLE[name])
    cols = sorted(d[0] for d in res.description)
    assert sorted(df.columns) == cols
    want = Counter(tuple(dict(zip([d[0] for d in res.description], r))[c] for c in cols) for r in res.fetchall())
    assert Counter(tuple(r[c] for c in cols) for r in df.collect()) == want


def test_op3_and_op8_match_the_libraries(spark, texts):
    enc = bpe.encoder()
    want = {}
    for d, t in texts.items():
        ids = enc.encode_ordinary(t or "")
        want[d] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
    assert {r["doc_id"]: tuple(r[1:]) for r in QUERIES["op3_bpe"](spark, SMALL).collect()} == want
    at, got = 0, {r["doc_id"]: tuple(r[1:]) for r in QUERIES["op8_tokens"](spark, SMALL).collect()}
    for d, t in sorted(texts.items()):
        ids = np.array([*enc.encode_ordinary(t or ""), 2], "<u4")
        assert got[d] == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_op4_matches_brute_force(spark, texts):
    raw = {d: (t or "").encode() for d, t in texts.items()}
    seen = Counter(b[i:i + 200] for b in raw.values() for i in range(len(b) - 199))
    got = {r["doc_id"]: tuple(r[1:]) for r in QUERIES["op4_suffixes"](spark, SMALL).collect()}
    for d, b in raw.items():
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 199):
            if seen[b[i:i + 200]] > 1:
                gone[i:i + 200] = True
        runs = int((np.diff(np.concatenate(([0], gone.astype(np.int8)))) == 1).sum())
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        assert got[d] == (len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())


def _rate(spark, name, label, df):
    y = spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", label)
    r = df.join(y, "doc_id").where("held_out").agg(F.avg((F.col("predicted") == F.col(label)).cast("int"))).first()[0]
    return r


def test_held_out_accuracy(spark):
    lang = QUERIES["op5_langid"](spark, SMALL).join(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang"), "doc_id")
    assert lang.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.9
    assert lang.where("score < 0 or score > 1").count() == 0
    for name, label in (("op6_quality", "quality"), ("op9_toxicity", "toxic")):
        df = QUERIES[name](spark, SMALL)
        assert df.where("score is null or score < 0 or score > 1").count() == 0
        assert _rate(spark, name, label, df) >= 0.75


def test_classifiers_on_odd_texts(spark, nasty_df, empty_df):
    docs = nasty_df.withColumn("lang", F.when(F.col("text").isNotNull() & (F.length("text") > 100), "xx"))
    model = langid.train(docs, fold(F.col("doc_id"), 4) != 2)
    got = docs.withColumn("p", langid.identify(spark, model)("text")).collect()
    for r in got:
        has = any(c.isalpha() for c in r["text"] or "")
        assert (r["p"]["lang_pred"] == "und") == (not has)
        assert 0 <= r["p"]["score"] <= 1 and r["score"] == "mine"
    assert langid.train(empty_df.withColumn("lang", F.lit("x")), F.lit(True)).langs == []
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as toxic", "cast(null as int) as quality")
    for mod, label in ((toxicity, "toxic"), (quality, "quality")):
        m = mod.train(nasty_df.select("doc_id", "text"), labels, F.lit(True), label=label)
        s = [r[0] for r in nasty_df.select(mod.scorer(spark, m)("text")).collect()]
        assert all(0 <= x <= 1 for x in s)
        assert empty_df.select(mod.scorer(spark, m)("text")).count() == 0


def test_toxicity_finds_rare_words_in_long_texts():
    rng = np.random.default_rng(0)
    vocab = ["".join(rng.choice(list("abcdefghij"), 4)) for _ in range(300)]
    rows, y = [], []
    for i in range(600):
        w = list(rng.choice(vocab, 200))
        if i % 10 == 0:
            w[50] = "zqxwv"
        rows.append(" ".join(w))
        y.append(int(i % 10 == 0))
    m = toxicity.fit([toxicity.features(t) for t in rows], np.array(y))
    assert m.score("aabb " * 300 + " zqxwv " + "cdef " * 300) > 0.5 > m.score("aabb ccdd " * 300)


def test_gam_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    m = quality.fit(x[:3000], y[:3000])
    assert ((m.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.9


def test_rules_on_odd_texts_and_any_order(spark, nasty, nasty_df, empty_df):
    import re

    rx = re.compile("[^\x20\x09-\x0d]+")
    want = Counter()
    for d, t in nasty:
        w = rx.findall(t or "")
        lines = [x for x in (t or "").split("\n") if rx.search(x)]
        win = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
        rep = {j for i in range(len(w) - 4) if win[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
        want[(d, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(rep))] += 1
    with Scratch(spark, "t") as s:
        rows = rules.apply_rules(nasty_df.drop("n_words"), s).collect()
        assert Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
                       for r in rows) == want
        counted = rules.counts(nasty_df.drop("n_words"))
        orders = [rules.rules(), rules.rules()[::-1]]
        a, b = (Counter((r["doc_id"], r["v"]) for r in counted.select("doc_id", rules.verdict(o).alias("v")).collect()) for o in orders)
        assert a == b
        assert rules.apply_rules(empty_df, s).count() == 0


def test_rule_order_is_by_rejection_per_cost(spark):
    sample = spark.range(100).toDF("x")
    todo = [rules.Rule("never", F.lit(False)), rules.Rule("most", F.col("x") > 10), rules.Rule("null", F.lit(None).cast("boolean"))]
    assert rules.ordered(sample, todo)[0].name == "most"
    assert sample.where(rules.verdict(todo)).count() == 11


def test_empty_tables(spark, empty_df):
    from marquee.llm import decontaminate, jaccard, warc

    bench = spark.createDataFrame([], "item_id long, text string")
    with Scratch(spark, "t") as s:
        assert decontaminate.contamination(empty_df, bench, "f", s).count() == 0
        assert sarray.remove_repeats(empty_df, "cut", s).count() == 0
        assert bpe.encode(empty_df, "ids", s).count() == 0
        assert jaccard.near_duplicates(empty_df, s)[1].count() == 0
        tokens.write_tokens(empty_df, path := s.path("store"))
        assert tokens.read_segments(spark, path).count() == 0
        warc.write_warc(spark.createDataFrame([], "page_id long, url string, html string"), path := s.path("arc"))
        assert warc.read_warc(spark, path, s).count() == 0


def test_pipeline_stages_decide(spark, texts):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    extra = spark.createDataFrame([(10**6, "123 456 !!", "en", "s", 10), (10**6 + 1, None, None, None, None),
                                   (10**6 + 2, "東京都は日本の首都であり世界最大の都市圏", "ja", "s", 20)], docs.schema)
    kept = corpus_pipeline.language(spark, docs.union(extra), SMALL)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert 10**6 not in ids and 10**6 + 1 not in ids and len(ids) >= len(texts)
    out = corpus_pipeline.run(spark, SMALL).collect()
    assert 0 < len(out) < len(texts) and all(r["round_trip"] for r in out)
    assert len({r["doc_id"] for r in out}) == len(out)
