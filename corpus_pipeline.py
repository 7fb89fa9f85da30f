"""From raw documents to token ids, each stage on all that the one before kept.

1. language ID: documents without a letter, or far from every language learnt
   from the table itself, go;
2. n-gram Jaccard join (five words, 0.8): of each component the document with
   the least id stays;
3. suffix-array dedup: strings of 200 bytes that occur again are cut out;
4. benchmark decontamination: documents with a benchmark passage go;
5. byte-level BPE: ids of what is left, decoded again as a check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import bpe, decontaminate, jaccard, langid, sarray
from marquee.llm.common import Scratch, fold, fresh, table
from marquee.session import ship_package

#: A document whose n-grams are this far out of place is in no learnt language.
MIN_LANGUAGE_SCORE = 0.05


#: Stored results of stages but the last, until a later stage starts on rows that are not read from them.
_results: list[DataFrame] = []


def _release(docs: DataFrame) -> None:
    """Deletes the results of earlier stages that ``docs`` does not read: who
    calls the stages has written their rows by then."""
    if not _results:
        return
    files = docs.inputFiles()
    for out in list(_results):
        folder = "/".join(out.stored_at.rsplit("/", 2)[1:])
        if not any(f"/{folder}/" in f for f in files):
            Scratch(docs.sparkSession, "released").delete(out.stored_at)
            _results.remove(out)


def _stored(s: Scratch, df: DataFrame, name: str = "t") -> DataFrame:
    out = s.keep(df, name, result=True)
    _results.append(out)
    return out


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a learnt language; learns as op5 does. Without any
    row to learn from it keeps all that have a letter."""
    ship_package(spark)
    model = langid.train(docs, fold(F.col("doc_id"), 4) != 2)
    if not model.langs:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    c = fresh(docs, "language")
    found = docs.withColumn(c, langid.identify(spark, model)("text"))
    return found.where((F.col(c)["lang_pred"] != langid.UNDETERMINED) & (F.col(c)["score"] >= MIN_LANGUAGE_SCORE)).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each component, and all without words."""
    ship_package(spark)
    _release(docs)
    with Scratch(spark, "near") as s:
        stored, result, row = jaccard.near_duplicates(docs, s)
        stay = result.where("first").select(F.col("row").alias(row))
        return _stored(s, stored.join(stay.hint("shuffle_hash"), row, "left_semi").select(docs.columns))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated strings out of the texts; characters that a cut splits go with it."""
    ship_package(spark)
    _release(docs)
    with Scratch(spark, "repeats") as s:
        got = sarray.cut_repeats(docs, s)
        if "n_chars" in docs.columns:
            got = got.withColumn("n_chars", F.length("text").cast("long"))
        return _stored(s, got.select(docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents without a benchmark window."""
    _release(docs)
    with Scratch(spark, "leaks") as s:
        c = fresh(docs, "found")
        got = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"), c, s)
        return _stored(s, got.where(F.col(c)["n_hit"] == 0).select(docs.columns))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, n_tokens, ids (little-endian unsigned 32-bit) and whether they decode to the text."""
    ship_package(spark)
    _release(docs)
    with Scratch(spark, "ids") as s:
        got = bpe.encode(docs.select("doc_id", "lang", "text"), "ids", s)
        same = bpe.decode()("ids") == F.coalesce("text", F.lit("")).cast("binary")
        return s.keep(got.select("doc_id", "lang", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
                                 same.alias("round_trip")), result=True)


STAGES = [("language_id", language), ("ngram_jaccard", near_duplicates), ("suffix_dedup", repeated_passages),
          ("decontamination", decontamination), ("byte_bpe", tokenize)]

ORACLE_SQL = None           # neither the learnt profiles nor the encoder's merges can be put in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. Each one's rows are written once, by the
    stage itself if it stores them anyway, and deleted when the next has read
    them; the last one's stay for the caller."""
    docs = table(spark, sf_dir, "documents")
    with Scratch(spark, "pipeline") as s:
        for name, stage in STAGES:
            out = stage(spark, docs, sf_dir)
            docs = out if hasattr(out, "stored_at") else _stored(s, out, name)
        _release(docs)
    return docs
