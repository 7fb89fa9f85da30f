"""Pair-index BPE against the library it must agree with."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from marquee.llm import bpe_index as bi
from marquee.llm.queries import QUERIES
from tests.conftest import SMALL

LIB = Tokenizer.from_file(bi.TOKENIZER)
PARTS = [*"aaab  \n\t'tsre.,!é東京𐐀\x1c\x85 　͸ᲀ٣ⅷ5", "<|endoftext|>", "<|endof", "'ll", " the", "  "]


def library(text):
    return LIB.encode(text, add_special_tokens=False).ids


def ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


def test_matches_the_library_on_odd_texts():
    rng = random.Random(1)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(0, 40))) for _ in range(1500)]
    texts += ["a" * 5000, "ab" * 3000, " " * 300 + "x", "\n" * 99, "", "é" * 1000, "<|endoftext|>" * 3, "東京" * 500]
    for t, got in zip(texts, bi.encode_block(texts)):
        assert ids(got) == library(t), t
        assert bi.decode_ids(got) == LIB.decode(ids(got), skip_special_tokens=False) == t


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=5))
def test_any_text_in_any_block(texts):
    assert [ids(x) for x in bi.encode_block(texts)] == [library(t) for t in texts]


def test_decoding_of_any_ids():
    rng = random.Random(2)
    for _ in range(200):
        some = [rng.randrange(50257) for _ in range(20)]
        assert bi.decode_ids(np.array(some, "<u4").tobytes()) == LIB.decode(some, skip_special_tokens=False)


def test_column_on_all_cases(spark, nasty, nasty_df, empty_df):
    got = bi.encode(nasty_df, "ids")
    assert got.columns == [*nasty_df.columns, "ids"]
    key = lambda x: (str(x[0]), str(x[1]))      # noqa: E731
    rows = sorted(((r["doc_id"], r["text"], ids(r["ids"]), r["row"]) for r in got.collect()), key=key)
    assert rows == sorted(((d, t, library(t or ""), "mine") for d, t in nasty), key=key)
    back = got.select("text", bi.decode_column()("ids").alias("again")).collect()
    assert all((r["text"] or "") == r["again"] for r in back)
    assert bi.encode(empty_df, "ids").count() == 0


def test_block_size_changes_nothing(nasty):
    texts = [t or "" for _, t in nasty]
    small = [x for b in bi.blocks(texts, 500) for x in bi.encode_block(b)]
    assert small == bi.encode_block(texts)


def test_vocabulary_whose_merges_are_out_of_order_is_refused(tmp_dir):
    import json

    spec = json.load(open(bi.TOKENIZER, encoding="utf-8"))
    spec["model"]["merges"].reverse()
    path = f"{tmp_dir}/odd.json"
    json.dump(spec, open(path, "w", encoding="utf-8"))
    with pytest.raises(ValueError, match="ranks before"):
        bi.Vocabulary(path)


def test_query_matches_the_library(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = {r["doc_id"]: tuple(r[1:]) for r in QUERIES["op12_bpe"](spark, SMALL).collect()}
    want = {}
    for d, t in texts.items():
        x = library(t)
        want[d] = (len(x), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest(),
                   hashlib.sha256(LIB.decode(x, skip_special_tokens=False).encode()).hexdigest())
    assert got == want
