"""The repeated passages of texts, cut out as the pipeline does it."""

from collections import Counter

from marquee.llm import sarray
from marquee.llm.common import Scratch


def test_texts_are_what_the_operator_keeps(spark, nasty_df, empty_df):
    with Scratch(spark, "t") as s:
        kept = sarray.remove_repeats(nasty_df, "cut", s)
        want = Counter((r["doc_id"], None if r["text"] is None else bytes(r["cut"]["kept"]).decode("utf-8", "ignore"), r["row"])
                       for r in kept.collect())
        got = sarray.cut_repeats(nasty_df, s)
        assert got.columns == nasty_df.columns
        assert Counter((r["doc_id"], r["text"], r["row"]) for r in got.collect()) == want
        assert sarray.cut_repeats(empty_df, s).count() == 0


def test_a_cut_through_a_character(spark):
    same = "é" * 150                    # 300 bytes
    docs = spark.createDataFrame([(1, "x" + same), (2, "Ã" + same[:120] + "tail")], "doc_id long, text string")
    with Scratch(spark, "t") as s:
        got = {r["doc_id"]: r["text"] for r in sarray.cut_repeats(docs, s).collect()}
    assert got[1] == "x" and got[2].endswith("tail") and "é" not in got[2]
