"""Collocations against a plain count of everything."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.llm import collocations as co
from marquee.llm.common import Scratch


def brute(rows, least, longest=4, cover=80, top=2000):
    """rows of (text, lang) -> (lang, rank, phrase, a, l, r, n, score)."""
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = [x for x in re.split("[ \t]", piece) if x]
            n[lang] += len(w)
            for m in range(1, longest + 1):
                for i in range(len(w) - m + 1):
                    f[lang][tuple(w[i:i + m])] += 1
    out = set()
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        drop = {p[i:i + m] for p, a in cand.items() for m in range(2, len(p)) for i in range(len(p) - m + 1)
                if 100 * a >= cover * cand[p[i:i + m]]}
        kept = []
        for p, a in cand.items():
            if p not in drop:
                score, _, left, right = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]])
                                            for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), left, right))
        for i, (s, a, p, left, right) in enumerate(sorted(kept)[:top]):
            out.add((lang, i + 1, p.decode(), -a, left, right, n[lang], -s))
    return out


def got(spark, df, **kw):
    with Scratch(spark, "t") as s:
        rows = co.mine(df, s, **kw)
        assert rows.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        rows = [tuple(r) for r in rows.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("least,top,block", [(30, 2000, 1 << 20), (3, 2000, 400), (3, 25, 3000), (2, 2000, 1)])
def test_matches_brute_force(spark, nasty, nasty_df, least, top, block):
    rng = random.Random(9)
    langs = [None, "und", "en", "fr"]
    rows = [(t, rng.choice(langs)) for _, t in nasty]
    rows += [("to be or not to be, That is;it x\x01y x y\t\tz x\x01y x y a a a a a a\r\nNew  York City new york city", "en")] * 12
    df = spark.createDataFrame(rows, "text string, lang string")
    for c in ("phrase", "n", "rank", "words", "f", "run", "own"):
        df = df.withColumn(c, F.lit("mine"))
    assert got(spark, df.repartition(4), least=least, top=top, block=block) == brute(rows, least, top=top)


def test_empty_table_and_texts_without_words(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    assert got(spark, empty) == set()
    assert got(spark, spark.createDataFrame([("", "en"), (None, None), (" .;\n", "en")], empty.schema)) == set()


def test_long_text_in_slices(monkeypatch):
    raw = b"Alpha beta, gamma\tdelta " * 400 + b"tail"
    whole = [t for part in co.tokens(raw) for t in part]
    monkeypatch.setattr(co, "SLICE", 37)
    assert [t for part in co.tokens(raw) for t in part] == whole


def test_filter_has_every_frequent_key(spark):
    keys = np.random.default_rng(4).integers(-2**63, 2**63, 5000, dtype=np.int64)
    df = spark.createDataFrame([(int(k),) for k in keys], "key long")
    known = co.Filter(*co._filter(df))
    assert known.has(keys.view(np.uint64)).all()
    other = np.random.default_rng(5).integers(-2**63, 2**63, 5000, dtype=np.int64)
    assert known.has(other.view(np.uint64)).mean() < 0.05


def test_small_filter_changes_nothing(spark, nasty, monkeypatch):
    """A filter that lets nearly all through only costs work."""
    rows = [(t, "en") for _, t in nasty]
    monkeypatch.setattr(co, "MAX_BITS", 16)
    monkeypatch.setattr(co, "BITS_PER_KEY", 1)
    df = spark.createDataFrame(rows, "text string, lang string")
    assert got(spark, df, least=4) == brute(rows, 4)
