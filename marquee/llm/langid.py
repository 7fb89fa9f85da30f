"""Language identification by rank-order profiles.

A language's profile is the list of its ``top`` most frequent n-grams of
letters (one to three, words padded with a boundary). A document's own list is
compared by out-of-place distance: for each of its n-grams, how far its rank is
from the rank in the profile, or ``top`` if the profile lacks it.
"""

from __future__ import annotations

import functools
import sys

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.llm.common import fold, table

UNDETERMINED = "und"
RESULT = "struct<lang_pred:string,score:double>"


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), dtype=bool)


def ngrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Codes of a text's n-grams and how often each occurs. A code holds up to
    three characters of 21 bits; 0 is the boundary around words."""
    if not text:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    c[~_letters()[c]] = 0
    c = np.concatenate(([0], c, [0]))
    c = c[np.append(True, (c[1:] != 0) | (c[:-1] != 0))]        # one boundary between words
    if len(c) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    two = (c[:-1] << 21) | c[1:]
    three = (two[:-1] << 21) | c[2:]
    one = c[c != 0]
    three = three[c[1:-1] != 0]                                  # no n-gram across words
    return np.unique(np.concatenate((one, two + (1 << 62), three)), return_counts=True)


def ranked(codes: np.ndarray, counts: np.ndarray, top: int) -> np.ndarray:
    """The most frequent codes, ties by code."""
    return codes[np.lexsort((codes, -counts))[:top]]


class Profiles:
    """Ranks of all profiles' n-grams as one table (rows: n-grams, columns: languages)."""

    def __init__(self, profiles: dict[str, list[int]], top: int):
        self.top, self.langs = top, sorted(profiles)
        self.codes = np.unique(np.array([c for p in profiles.values() for c in p], dtype=np.int64))
        self.ranks = np.full((len(self.codes) + 1, len(self.langs)), -1, dtype=np.int64)
        for j, lang in enumerate(self.langs):
            p = np.array(profiles[lang], dtype=np.int64)
            self.ranks[np.searchsorted(self.codes, p), j] = np.arange(len(p))

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, score): the nearest profile, ties by name. The score is
        how far the document's list is from being wholly out of place there."""
        own = ranked(*ngrams(text), self.top)
        if not len(own) or not self.langs:
            return UNDETERMINED, 0.0
        i = np.searchsorted(self.codes, own)
        i[i == len(self.codes)] = 0
        i[self.codes[i] != own] = len(self.codes)
        r = self.ranks[i]
        d = np.where(r >= 0, np.abs(r - np.arange(len(own))[:, None]), self.top).sum(axis=0)
        k = int(np.argmin(d))
        return self.langs[k], float(1 - d[k] / (self.top * len(own)))


def training_rows(docs: DataFrame, usable: Column, label: str, text: str, key: str, per_label: int) -> DataFrame:
    """At most ``per_label`` rows of each label, the first by a hash of the key."""
    t = docs.where(usable & F.col(label).isNotNull() & F.col(text).isNotNull()).select(
        F.col(label).alias("label"), F.col(text).alias("t"), F.xxhash64(key).alias("h"), F.col(key).alias("k"))
    w = Window.partitionBy("label").orderBy("h", "k")
    # the keys are chosen without the texts, so hot labels move little; null keys never join
    chosen = t.select("label", "h", "k").withColumn("r", F.row_number().over(w)).where(f"r <= {per_label}")
    picked = [(r["label"], r["k"]) for r in chosen.toLocalIterator()]
    small = docs.sparkSession.createDataFrame(picked, "label string, k string") if picked else None
    return t.limit(0).drop("h", "k") if small is None else (
        t.withColumn("k", F.col("k").cast("string")).join(F.broadcast(small.distinct()), ["label", "k"], "left_semi")
        .drop("h", "k"))


def train(docs: DataFrame, usable: Column, text: str = "text", lang: str = "lang", key: str = "doc_id",
          top: int = 400, per_lang: int = 2000) -> Profiles:
    """Profiles of the languages that rows with ``usable`` name, from at most
    ``per_lang`` documents each (the bound of the sample). Rows without text
    or language teach nothing. What reaches the driver is ``top`` n-grams a
    language and the sample's keys."""
    rows = training_rows(docs, usable, lang, text, key, per_lang)

    def count(batches):
        for b in batches:
            for label, t in b.groupby("label")["t"]:
                got = [ngrams(x) for x in t]
                codes, where = np.unique(np.concatenate([g[0] for g in got]), return_inverse=True)
                n = np.bincount(where, np.concatenate([g[1] for g in got]), len(codes)).astype(np.int64)
                yield pd.DataFrame({"label": label, "code": codes, "n": n})

    sums = rows.mapInPandas(count, "label string, code long, n long").groupBy("label", "code").agg(F.sum("n").alias("n"))
    w = Window.partitionBy("label").orderBy(F.desc("n"), "code")
    best = sums.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
    profiles: dict[str, list[int]] = {}
    for r in sorted(best.toLocalIterator(), key=lambda r: (r["label"], r["rank"])):
        profiles.setdefault(r["label"], []).append(r["code"])
    return Profiles(profiles, top)


def identify(spark: SparkSession, model: Profiles):
    """A column function: text -> struct(lang_pred, score). Null texts and
    texts without a letter are ``und`` with score 0; whole texts are read,
    repeated rows get the same answer, other columns are not touched."""
    sent = spark.sparkContext.broadcast(model)

    @F.pandas_udf(RESULT)
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([sent.value.predict(t) for t in texts], columns=["lang_pred", "score"])

    return predict


def q_op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learnt from three folds of four."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = fold(F.col("doc_id"), 4) == 2
    predict = identify(spark, train(docs, ~held))
    return docs.select("doc_id", held.alias("held_out"), predict("text").alias("p")).select(
        "doc_id", "held_out", "p.lang_pred", "p.score")
