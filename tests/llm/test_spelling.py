"""Spelling variants against a comparison of all pairs."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.llm import spelling as sp
from marquee.llm.common import Scratch


def near(a, b):
    """Exactly one code point inserted, deleted or replaced."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def words_of(rows, every=199, shortest=6, least=5):
    n = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= shortest and k >= least}


def brute(n, times=5):
    out, form = {}, {}
    for w in n:
        close = [x for x in n if near(w, x)]
        best = min(close, key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= times * n[w]:
            form[w] = best
        out[w] = len(close)
    rows = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        rows.add((w, form.get(w), root, n[w], out[w], n[form[w]] if w in form else None))
    return rows


def got(spark, df, **kw):
    with Scratch(spark, "t") as s:
        res = sp.variants(df, s, **kw)
        assert res.columns == ["word", "form", "root", "n", "n_near", "form_n"]
        rows = [tuple(r) for r in res.collect()]
    assert len(rows) == len({r[0] for r in rows})
    return set(rows)


def misspelt(rng, n_docs=120):
    base = ["".join(rng.choice("abcdeéñzw") for _ in range(rng.choice([6, 6, 7, 8, 12]))) for _ in range(60)]
    docs = []
    for i in range(n_docs):
        words = []
        for _ in range(120):
            w = base[int(rng.random() ** 2 * len(base))]
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):        # chains of edits
                at, c = rng.randrange(len(w)), rng.choice("abÉx")
                w = rng.choice([w[:at] + w[at + 1:], w[:at] + c + w[at:], w[:at] + c + w[at + 1:]])
            words.append(rng.choice([w, w, w.upper().replace("É", "é").replace("Ñ", "ñ"), w.capitalize()]))
        docs.append((i if i else None, " ".join(words) + rng.choice(["", ".", "x1y", "\x00 東京"])))
    return docs


@pytest.mark.parametrize("groups,rows", [(None, 1024), (3, 4), (5, 64), (8, 1024)])
def test_matches_brute_force(spark, monkeypatch, groups, rows):
    monkeypatch.setattr(sp, "ROWS", rows)
    docs = misspelt(random.Random(groups or 1))
    docs += [(400, "chainword " * 130 + "chainwordx " * 26 + "chainwordxé " * 5)]
    docs += [(500 + i, "A" * 3000 + " " + "a" * 2999 + " " + "a" * 2998 + "b") for i in range(6)]      # very long words
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for c in ("word", "n", "cell", "block", "length"):
        df = df.withColumn(c, F.lit("mine"))
    n = words_of(docs)
    assert len(n) > 100
    want = brute(n)
    assert any(r[1] == "chainwordx" and r[2] == "chainword" for r in want)
    assert got(spark, df.repartition(3), groups=groups) == want


def test_nasty_rows_and_empty_table(spark, nasty, nasty_df, empty_df):
    assert got(spark, nasty_df) == brute(words_of(nasty))
    assert got(spark, empty_df) == set()


def test_kernel_finds_each_pair_once():
    rng = np.random.default_rng(3)
    for la, lb in ((6, 6), (6, 7), (9, 9)):
        a = rng.integers(97, 101, (150, la)).astype(np.uint8)
        b = rng.integers(97, 101, (140, lb)).astype(np.uint8)
        b[:40, :la] = a[:40]
        i, j = sp.close_pairs(a, b)
        ok = sp.one_edit(a[i], b[j])
        want = {(x, y) for x in range(len(a)) for y in range(len(b)) if near(a[x].tobytes().decode(), b[y].tobytes().decode())}
        assert set(zip(i[ok].tolist(), j[ok].tolist())) == want and len(want)


def test_neighbouring_cells_cover_every_edit():
    rng = random.Random(4)
    for groups in (3, 6, 11):
        moves = {tuple(m) for m in sp._moves(groups)}
        cell = lambda w: [sum(c in sp.LETTERS[g::groups] for c in w) for g in range(groups)]        # noqa: E731
        for _ in range(400):
            w = "".join(rng.choice(sp.LETTERS) for _ in range(8))
            at, c = rng.randrange(8), rng.choice(sp.LETTERS)
            for v in (w[:at] + c + w[at + 1:], w[:at] + c + w[at:]):
                d = [y - x for x, y in zip(cell(w), cell(v))]
                assert (tuple(d) in moves) or (tuple(-x for x in d) in moves)


def test_letters_are_all_there():
    assert sorted(sp.LETTERS) == sorted([chr(c) for c in range(97, 123)] + [chr(c) for c in range(0xC0, 0x100)])


def test_times_below_two_is_refused(spark, empty_df):
    with pytest.raises(ValueError):
        sp.variants(empty_df, None, times=1)
