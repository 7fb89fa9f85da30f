"""Toxicity: a character n-gram linear classifier with naive Bayes scaling.

Features are the distinct character n-grams (three to five bytes, ASCII case
ignored, white space as one boundary) of a text, hashed into ``bins``. Each is
scaled by its log-count ratio between toxic and other training texts, and a
logistic regression is trained on the scaled features.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.common import ASCII_LOWER, fold, table

BINS = 1 << 20
ORDERS = (3, 4, 5)
_TABLE = bytes(32 if b in b" \t\n\r\x0b\x0c" else ASCII_LOWER[b] for b in range(256))


def features(text: str | None, bins: int = BINS) -> np.ndarray:
    """Sorted distinct bins of a text's n-grams."""
    raw = b" ".join((text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split())
    if not raw:
        return np.empty(0, np.int32)
    b = np.frombuffer(b" " + raw + b" ", dtype=np.uint8).astype(np.uint64)
    out = []
    for n in ORDERS:
        m = len(b) - n + 1
        if m < 1:
            continue
        code = np.zeros(m, np.uint64)
        for i in range(n):
            code |= b[i:i + m] << np.uint64(8 * i)
        code *= np.uint64(0x9E3779B97F4A7C15)
        out.append((code >> np.uint64(40)).astype(np.int64) & (bins - 1))
    return np.unique(np.concatenate(out)).astype(np.int32) if out else np.empty(0, np.int32)


class Model:
    """Weights by bin (log-count ratio times the learnt coefficient) and a bias."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights.astype(np.float32), float(bias)

    def score(self, text: str | None) -> float:
        z = self.bias + float(self.weights[features(text, len(self.weights))].sum(dtype=np.float64))
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def fit(rows: list[np.ndarray], y: np.ndarray, bins: int = BINS, min_docs: int = 3, alpha: float = 1.0,
        l2: float = 0.02, epochs: int = 150) -> Model:
    """Full-batch logistic regression (Adam) on the scaled features; classes
    weigh alike in the ratios, not in the loss, so scores stay calibrated."""
    y = np.asarray(y, float)
    prior = (y.sum() + 0.5) / (len(y) + 1)
    bias0 = float(np.log(prior / (1 - prior)))
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(bins), bias0)
    df, pos = np.zeros(bins, np.int64), np.zeros(bins)
    for r, t in zip(rows, y):                   # a row's bins are distinct
        df[r] += 1
        pos[r] += t
    n1, n0 = y.sum(), (1 - y).sum()
    p, q = (pos + alpha) / (n1 + 2 * alpha), (df - pos + alpha) / (n0 + 2 * alpha)
    ratio = np.log(p / q)
    # the signal of a bin: how far its ratio stands out of the noise of its counts
    z = np.abs(ratio) / np.sqrt(1 / (pos + alpha) + 1 / (df - pos + alpha))
    use = np.flatnonzero((df >= min_docs) & (z > 2.5))
    if not len(use):
        return Model(np.zeros(bins), bias0)
    new = np.full(bins, -1)
    new[use] = np.arange(len(use))
    kept = [c[c >= 0] for c in (new[r] for r in rows)]
    at = np.repeat(np.arange(len(kept)), [len(c) for c in kept])
    col = np.concatenate(kept)
    r = ratio[use]
    w, b = np.zeros(len(use)), bias0
    m = np.zeros(len(use) + 1)
    v = np.zeros(len(use) + 1)
    for t in range(1, epochs + 1):
        x = r * w
        s = 1 / (1 + np.exp(-np.clip(b + np.bincount(at, x[col], len(y)), -40, 40)))
        e = s - y
        g = np.append(np.bincount(col, e[at], len(use)) * r / len(y) + l2 / len(use) * w, e.mean())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    weights = np.zeros(bins)
    weights[use] = r * w
    return Model(weights, b)


def labelled(docs: DataFrame, labels: DataFrame, label: str, usable: Column, limit: int, key: str = "doc_id",
             text: str = "text") -> DataFrame:
    """(t, y): at most ``limit`` labelled texts, the first by a hash of the key;
    rows without text or label are left out, a key with several labels takes the largest."""
    spark = docs.sparkSession
    y = labels.where(usable & F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("k")).agg(
        F.max(label).cast("int").alias("y"))
    first = y.orderBy(F.xxhash64("k"), "k").limit(limit)
    picked = [(r["k"], r["y"]) for r in first.toLocalIterator()]
    small = spark.createDataFrame(picked, "k long, y int")            # at most ``limit`` rows
    return docs.select(F.col(key).alias("k"), F.col(text).alias("t")).join(F.broadcast(small), "k").where(
        "t is not null").select("t", "y")


def train(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "toxic", limit: int = 10_000,
          bins: int = BINS) -> Model:
    """Fits the classifier on a bounded sample of labelled rows; tasks make the
    features, the driver fits."""
    def make(batches):
        for b in batches:
            yield pd.DataFrame({"x": [features(t, bins).tobytes() for t in b["t"]], "y": b["y"]})

    got = [(r["x"], r["y"]) for r in
           labelled(docs, labels, label, usable, limit).mapInPandas(make, "x binary, y int").toLocalIterator()]
    return fit([np.frombuffer(x, np.int32) for x, _ in got], np.array([y for _, y in got]), bins)


def scorer(spark: SparkSession, model: Model):
    """A column function: text -> score. Null and empty texts get the bias
    alone; whole texts are read, repeated rows score alike."""
    sent = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([sent.value.score(t) for t in texts], dtype=float)

    return score


def q_op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; learnt from four folds of five."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"), fold(F.col("doc_id"), 5) != 0)
    out = docs.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), scorer(spark, model)("text").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
