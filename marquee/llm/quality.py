"""Quality: a generalised additive model with pairwise interactions.

Cyclic boosting visits one feature after the other and adds a shallow tree
(a few cuts of that feature's bins) fitted to the residuals, each scaled
down; the trees of a feature sum to one lookup table. The strongest pairs of
features then get two-dimensional tables in the same way. A score is a sum of
table entries, looked up by bin for a whole batch at a time.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.common import fold, table
from marquee.llm.toxicity import labelled

NAMES = ("chars", "words", "word_length", "symbols", "digits", "upper", "punctuation", "marks", "letters", "lines",
         "words_a_line", "repeated_lines", "distinct_words", "repeated_runs", "upper_words", "short_words",
         "long_words", "bars")
_SYMBOLS, _MARKS, _PUNCT = set("#*$%&<>{}[]~^\\=+_@"), set("!?"), re.compile(r"[.,;:]")
_COUNT = {c: re.compile("[" + "".join(map(re.escape, sorted(s))) + "]") for c, s in (("symbols", _SYMBOLS), ("marks", _MARKS))}
_DIGIT, _UPPER, _LETTER = re.compile(r"[0-9]"), re.compile(r"[A-Z]"), re.compile(r"[^\W\d_]")


def features(text: str | None) -> list[float]:
    """What NAMES says, from the whole text; a null text is empty."""
    t = text or ""
    words = t.split()
    lines = [x for x in t.split("\n") if x.strip()]
    n, k, m = max(len(t), 1), max(len(words), 1), max(len(lines), 1)
    count = lambda rx: len(rx.findall(t)) / n
    runs = list(zip(words, words[1:], words[2:]))
    return [np.log1p(len(t)), np.log1p(len(words)), sum(map(len, words)) / k, count(_COUNT["symbols"]), count(_DIGIT),
            count(_UPPER), count(_PUNCT), count(_COUNT["marks"]), sum(map(len, _WORDS.findall(t))) / n, np.log1p(len(lines)),
            np.log1p(len(words) / m), 1 - len(set(lines)) / m if lines else 0.0, len(set(words)) / k if words else 0.0,
            1 - len(set(runs)) / len(runs) if runs else 0.0, sum(w.isupper() for w in words) / k,
            sum(len(w) <= 2 for w in words) / k, sum(len(w) >= 12 for w in words) / k, t.count("|") / k]


_WORDS = re.compile(r"[^\W\d_]+")


class Gam:
    """Lookup tables: ``cuts`` and ``main`` by feature, ``pairs`` with a table each."""

    def __init__(self, bias: float, cuts: list[np.ndarray], main: list[np.ndarray],
                 pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]):
        self.bias, self.cuts, self.main, self.pairs = bias, cuts, main, pairs

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for the rows of ``x``."""
        z = np.full(len(x), self.bias)
        for j, (c, t) in enumerate(zip(self.cuts, self.main)):
            z += t[np.searchsorted(c, x[:, j], side="right")]
        for i, j, ci, cj, t in self.pairs:
            z += t[np.searchsorted(ci, x[:, i], side="right"), np.searchsorted(cj, x[:, j], side="right")]
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _cuts(v: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(v, np.linspace(0, 1, bins + 1)[1:-1]))


def _shallow_tree(b: np.ndarray, n: int, g: np.ndarray, h: np.ndarray, leaves: int, l2: float) -> np.ndarray:
    """Newton step by leaf of a greedy tree over bins 0..n-1, as a table."""
    G, H = np.bincount(b, g, n), np.bincount(b, h, n)
    edges = [(0, n)]
    cg, ch = np.append(0, np.cumsum(G)), np.append(0, np.cumsum(H))
    gain = lambda a, z: (cg[z] - cg[a]) ** 2 / (ch[z] - ch[a] + l2)
    while len(edges) < leaves:
        best = max(((gain(a, c) + gain(c, z) - gain(a, z), a, c, z) for a, z in edges for c in range(a + 1, z)), default=None)
        if best is None or best[0] <= 1e-9:
            break
        _, a, c, z = best
        edges.remove((a, z))
        edges += [(a, c), (c, z)]
    t = np.zeros(n)
    for a, z in edges:
        t[a:z] = (cg[z] - cg[a]) / (ch[z] - ch[a] + l2)
    return t


def fit(x: np.ndarray, y: np.ndarray, bins: int = 32, rounds: int = 60, rate: float = 0.15, leaves: int = 3,
        n_pairs: int = 6, pair_bins: int = 8, l2: float = 5.0) -> Gam:
    """Cyclic boosting on logistic loss: mains first, then the ``n_pairs``
    pairs whose tables reduce what is left the most."""
    n, p = x.shape
    prior = (y.sum() + 0.5) / (n + 1)
    bias = float(np.log(prior / (1 - prior)))
    cuts = [_cuts(x[:, j], bins) if n else np.empty(0) for j in range(p)]
    main = [np.zeros(len(c) + 1) for c in cuts]
    if not n or y.min() == y.max():
        return Gam(bias, cuts, main, [])
    b = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(cuts)]
    z = np.full(n, bias)
    residual = lambda: (y - (s := 1 / (1 + np.exp(-z))), np.maximum(s * (1 - s), 1e-6))
    for _ in range(rounds):
        for j in range(p):
            t = rate * _shallow_tree(b[j], len(main[j]), *residual(), leaves, l2)
            main[j] += t
            z += t[b[j]]
    pc = [_cuts(x[:, j], pair_bins) for j in range(p)]
    pb = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(pc)]

    def grid(i, j):
        g, h = residual()
        k, w = len(pc[j]) + 1, (len(pc[i]) + 1) * (len(pc[j]) + 1)
        cell = pb[i] * k + pb[j]
        G, H = np.bincount(cell, g, w), np.bincount(cell, h, w)
        return cell, (G / (H + l2)), float((G**2 / (H + l2)).sum())

    ranked = sorted(((grid(i, j)[2], i, j) for i in range(p) for j in range(i + 1, p)), reverse=True)[:n_pairs]
    tables = {(i, j): np.zeros((len(pc[i]) + 1) * (len(pc[j]) + 1)) for _, i, j in ranked}
    for _ in range(rounds // 2):
        for i, j in tables:
            cell, step, _ = grid(i, j)
            tables[i, j] += rate * step
            z += rate * step[cell]
    return Gam(bias, cuts, main, [(i, j, pc[i], pc[j], t.reshape(len(pc[i]) + 1, -1)) for (i, j), t in tables.items()])


def train(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "quality", limit: int = 20_000) -> Gam:
    """Fits the model on a bounded sample of labelled rows; tasks make the
    features, the driver fits the tables."""
    def make(batches):
        for f in batches:
            yield pd.DataFrame({"x": [features(t) for t in f["t"]], "y": f["y"]})

    got = [(r["x"], r["y"]) for r in
           labelled(docs, labels, label, usable, limit).mapInPandas(make, "x array<double>, y int").toLocalIterator()]
    x = np.array([r[0] for r in got], float).reshape(len(got), len(NAMES))
    return fit(x, np.array([r[1] for r in got], float))


def scorer(spark: SparkSession, model: Gam):
    """A column function: text -> score. Null texts score like empty ones;
    whole texts are read, repeated rows score alike."""
    sent = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        x = np.array([features(t) for t in texts], float).reshape(len(texts), len(NAMES))
        return pd.Series(sent.value.score(x))

    return score


def q_op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; learnt from four folds of five."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"), fold(F.col("doc_id"), 5) != 0)
    out = docs.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), scorer(spark, model)("text").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))
