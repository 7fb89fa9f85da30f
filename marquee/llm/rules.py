"""Quality rules as a short-circuit cascade, built-in functions only.

A document is dropped if any rule rejects it, so the order of the rules does
not change the verdict, only its cost. Each rule's cost and rejected share are
measured on a sample, and the rules are tried by rejection per cost: a CASE
expression stops at the first that rejects.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.common import Scratch, table

# fixed values: the white space between words, and the symbols that are counted
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """``rejects`` is a boolean column over the counts and the text."""

    name: str
    rejects: Column


def rules(text: str = "text") -> list[Rule]:
    """The verdict's rules. All are conservative: they aim at markup, lists of
    codes, shouting and copied lines, not at prose of any language."""
    t = F.coalesce(F.col(text), F.lit(""))
    upper = F.length(t) - F.length(F.translate(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    lower = F.length(t) - F.length(F.translate(t, "abcdefghijklmnopqrstuvwxyz", ""))
    digits = F.length(t) - F.length(F.translate(t, "0123456789", ""))
    return [
        Rule("symbols", F.col("n_symbols") * 4 > F.col("n_words")),
        Rule("copied_lines", F.col("n_dup_lines") * 10 > F.col("n_lines") * 3),
        Rule("tiny_words", F.col("word_chars") * 2 < F.col("n_words") * 3),
        Rule("shouting", (upper > lower) & (upper >= 40)),
        Rule("digits", digits * 2 > F.col("word_chars")),
    ]


def counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, n_lines (with a word), word_chars, n_symbols,
    n_dup_lines and n_repeat_words of whole texts.

    A null text has no words; texts shorter than a window have no repeats.
    Columns of these names are replaced; names that begin with ``rule_`` are
    used on the way.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    trimmed = F.btrim(F.col("rule_text"), F.lit(SPACES))
    d = docs.withColumn("rule_text", t)
    d = d.withColumn("rule_words", F.when(trimmed == "", F.array().cast("array<string>"))
                     .otherwise(F.split(trimmed, "[ \\t-\\r]+")))
    d = d.withColumn("rule_lines", F.filter(F.split("rule_text", "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != ""))
    d = d.withColumns({
        "n_words": F.size("rule_words").cast("long"),
        "n_lines": F.size("rule_lines").cast("long"),
        "word_chars": F.length(F.translate("rule_text", SPACES, "")).cast("long"),
        "n_symbols": (F.length("rule_text") - F.length(F.translate("rule_text", SYMBOLS, ""))).cast("long"),
        "n_dup_lines": (F.size("rule_lines") - F.size(F.array_distinct("rule_lines"))).cast("long"),
    })
    word = lambda i, k: F.get("rule_words", i + F.lit(k))
    # hashes of all windows; only texts with an equal pair go on to find where
    d = d.withColumn("rule_win", F.when(F.col("n_words") >= WINDOW, F.transform(
        F.sequence(F.lit(0), (F.col("n_words") - WINDOW).cast("int")),
        lambda i: F.xxhash64(*[word(i, k) for k in range(WINDOW)]))))
    repeats = F.size(F.array_distinct("rule_win")) < F.size("rule_win")
    d = d.withColumn("rule_sorted", F.when(repeats, F.sort_array(
        F.transform("rule_win", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))

    def same(x: Column, j: Column) -> Column:
        other = F.get("rule_sorted", j)
        window = lambda i: F.slice("rule_words", i + 1, WINDOW)
        return F.coalesce((other["h"] == x["h"]) & (window(other["i"]) == window(x["i"])), F.lit(False))

    d = d.withColumn("rule_at", F.sort_array(F.transform(
        F.filter("rule_sorted", lambda x, j: same(x, j - 1) | same(x, j + 1)), lambda x: x["i"])))
    covered = F.aggregate(
        F.transform("rule_at", lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get("rule_at", j + 1) - p, F.lit(WINDOW)))),
        F.lit(0), lambda acc, x: acc + x)
    d = d.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
    return d.drop("rule_text", "rule_words", "rule_lines", "rule_win", "rule_sorted", "rule_at")


def ordered(sample: DataFrame, todo: list[Rule]) -> list[Rule]:
    """The rules by rejected share per second, both measured on ``sample`` (a
    stored table with the counts); ties and empty samples keep their order."""
    rate = []
    for r in todo:
        agg = sample.agg(F.avg(F.coalesce(r.rejects, F.lit(False)).cast("int")).alias("share"))
        began = time.perf_counter()
        share = agg.first()["share"] or 0.0
        rate.append(share / max(time.perf_counter() - began, 1e-6))
    return [r for _, r in sorted(zip(rate, todo), key=lambda x: -x[0])]


def verdict(order: list[Rule]) -> Column:
    """False at the first rule that rejects; later rules are not evaluated. A
    rule over a null does not reject."""
    v = None
    for r in order:
        v = F.when(r.rejects, False) if v is None else v.when(r.rejects, False)
    return F.lit(True) if v is None else v.otherwise(True)


def apply_rules(docs: DataFrame, scratch: Scratch, text: str = "text", sample_rows: int = 2000,
                todo: list[Rule] | None = None) -> DataFrame:
    """``docs`` with the counts, base_failed and kept. ``sample_rows`` bounds
    the rows that cost and selectivity are measured on."""
    todo = rules(text) if todo is None else todo
    counted = counts(docs, text)
    sample = scratch.keep(counts(docs.limit(sample_rows), text), "sample")
    base = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    return counted.withColumn("base_failed", base).withColumn(
        "kept", ~F.col("base_failed") & verdict(ordered(sample, todo)))


def q_op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    with Scratch(spark, "op7") as s:
        return apply_rules(docs, s).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                           "n_repeat_words", "base_failed", "kept")
