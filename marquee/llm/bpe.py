"""Byte-level BPE: overlapping chunk encoding, and decoding.

Texts longer than ``chunk`` characters are cut into chunks that overlap, and
the chunks are pre-tokenised in parallel. Matching is forward only, so two
neighbours that both start a pre-token at one place of their overlap agree
from there on: the text is cut there (the chunk before keeps what ends there,
the next one goes on), and the pieces are encoded each on its own. Where an
overlap has no common start (a run of letters or spaces longer than it), the
two chunks stay one piece. Shorter texts are one piece and never move.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.common import Scratch, fresh, shuffle_partitions, table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: White space as the encoder's regular expressions see it; other libraries count the separators 1C-1F too.
SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


@functools.cache
def encoder(path: str = RANKS):
    """The encoder of a rank file, built once per Python worker."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@functools.cache
def _pattern():
    p = public_tokenizers.PATTERN.replace(r"[^\s\p{L}\p{N}]", rf"[^{SPACE}\p{{L}}\p{{N}}]")
    return regex.compile(p.replace(r"\s", f"[{SPACE}]").replace(r"\S", f"[^{SPACE}]"))


def starts(text: str) -> list[int]:
    """Where pre-tokens start in a scan of ``text`` right after a visible
    character. (What is cut off after white space would lose the sight of the
    character that decides how that white space splits.)"""
    return [m.start() for m in _pattern().finditer(text) if m.start() and not _space().match(text, m.start() - 1)]


@functools.cache
def _space():
    return regex.compile(f"[{SPACE}]")


def resync(left: list[int], right: list[int]) -> int | None:
    """First common start in an overlap, counted from its begin."""
    return min(set(left).intersection(right), default=None)


def encode_text(text: str, path: str = RANKS) -> bytes:
    """Ids of a text as little-endian unsigned 32-bit integers."""
    return np.array(encoder(path).encode_ordinary(text), dtype="<u4").tobytes()


def decode_ids(ids: bytes, path: str = RANKS) -> bytes:
    """Raw bytes of the ids, concatenated."""
    return encoder(path).decode_bytes(np.frombuffer(ids, dtype="<u4").tolist())


def encode_short(path: str = RANKS):
    """A column function: text -> ids of the whole text in one piece."""
    @F.pandas_udf("binary")
    def one(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: encode_text(t or "", path))

    return one


def _chunks(batches: Iterator[pa.RecordBatch], chunk: int, overlap: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for row, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            for k, at in enumerate(range(0, len(text), chunk)):
                yield pa.RecordBatch.from_arrays([
                    pa.array([row], pa.int64()), pa.array([k], pa.int64()),
                    pa.array([text[at:at + chunk + overlap]], pa.large_string())], names=["row", "k", "text"])


def _edges(batches: Iterator[pa.RecordBatch], chunk: int, overlap: int) -> Iterator[pa.RecordBatch]:
    """Pre-tokenises each chunk; of the starts, those in the overlaps with its
    neighbours are what stitching needs (offsets from the chunk's begin)."""
    for b in batches:
        head, tail = [], []
        for t in b.column(2).to_pylist():
            s = starts(t)
            head.append([x for x in s if x <= overlap])
            tail.append([x - chunk for x in s if chunk <= x <= len(t) - 3])    # 3: the longest contraction
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(head, pa.list_(pa.int32())),
                                          pa.array(tail, pa.list_(pa.int32()))], names=["row", "k", "head", "tail"])


def _stitch(key, pdf: pd.DataFrame, chunk: int) -> pd.DataFrame:
    """Cuts of one text: (piece, chunk, from, to) with offsets in the chunk."""
    pdf = pdf.sort_values("k")
    out, piece, begin, before = [], 0, 0, None
    for k, head, tail in zip(pdf["k"], pdf["head"], pdf["tail"]):
        cut = None if before is None else resync(list(before), list(head))
        if before is not None:
            out.append((key[0], piece, k - 1, begin, chunk + (cut or 0)))
            piece += cut is not None
            begin = cut or 0
        before = tail
    out.append((key[0], piece, pdf["k"].iloc[-1], begin, -1))
    return pd.DataFrame(out, columns=["row", "piece", "k", "a", "z"])


def _encode_pieces(batches: Iterator[pd.DataFrame], path: str) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pd.DataFrame({"row": pdf["row"], "piece": pdf["piece"],
                            "ids": [encode_text("".join(x["part"] for x in sorted(parts, key=lambda x: x["k"])), path)
                                    for parts in pdf["parts"]]})


def _concat():
    @F.pandas_udf("binary")
    def one(parts: pd.Series) -> pd.Series:
        return parts.map(lambda p: b"".join(x["ids"] for x in p))

    return one


def _long(rows: DataFrame, chunk: int, overlap: int, path: str, scratch: Scratch) -> DataFrame:
    """(row, ids) of texts longer than a chunk."""
    n = shuffle_partitions(rows.sparkSession)
    parts = scratch.keep(rows.mapInArrow(lambda it: _chunks(it, chunk, overlap), "row long, k long, text string")
                         .repartition(n, "row", "k"), "chunks")
    edges = parts.mapInArrow(lambda it: _edges(it, chunk, overlap),
                             "row long, k long, head array<int>, tail array<int>")
    cuts = edges.groupBy("row").applyInPandas(lambda key, pdf: _stitch(key, pdf, chunk),
                                              "row long, piece long, k long, a long, z long")
    piece = parts.join(cuts, ["row", "k"]).select(
        "row", "piece", F.struct("k", F.when(F.col("z") < 0, F.substring("text", F.col("a") + 1, F.length("text")))
                                 .otherwise(F.substring("text", F.col("a") + 1, F.col("z") - F.col("a"))).alias("part"))
        .alias("p"))
    whole = piece.groupBy("row", "piece").agg(F.collect_list("p").alias("parts"))
    ids = whole.mapInPandas(lambda it: _encode_pieces(it, path), "row long, piece long, ids binary")
    joined = ids.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("piece", "ids"))).alias("p"))
    return joined.select("row", _concat()("p").alias("ids"))


def encode(docs: DataFrame, out: str, scratch: Scratch, text: str = "text", path: str = RANKS,
           chunk: int = 1 << 15, overlap: int = 1 << 10) -> DataFrame:
    """``docs`` with a binary column ``out``: the text's ids, little-endian
    unsigned 32-bit integers. A null text is empty and has no ids; strings of
    special tokens are ordinary text; repeated rows are encoded alike. All
    other columns stay; ``out`` must not be one of them."""
    is_long = F.coalesce(F.length(text) > chunk, F.lit(False))
    short = docs.where(~is_long).withColumn(out, encode_short(path)(F.col(text)))
    row = fresh(docs, "row")
    long = scratch.keep(docs.where(is_long).withColumn(row, F.monotonically_increasing_id()), "long")
    ids = _long(long.select(F.col(row).alias("row"), F.col(text).alias("text")), chunk, overlap, path, scratch)
    ids = ids.select(F.col("row").alias(row), F.col("ids").alias(out))
    return short.unionByName(long.join(ids, row).drop(row))


def decode(path: str = RANKS):
    """A column function: ids -> the raw bytes of the text."""
    @F.pandas_udf("binary")
    def one(ids: pd.Series) -> pd.Series:
        return ids.map(lambda b: decode_ids(b, path))

    return one


def _digest():
    @F.pandas_udf("struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>")
    def one(ids: pd.Series) -> pd.DataFrame:
        rows = []
        for b in ids:
            a = np.frombuffer(b, dtype="<u4")
            rows.append((len(a), hashlib.sha256(" ".join(map(str, a.tolist())).encode()).hexdigest(),
                         hashlib.sha256(decode_ids(b)).hexdigest()))
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return one


def q_op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, decoded again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    with Scratch(spark, "op3") as s:
        got = encode(docs, "ids", s).select("doc_id", _digest()("ids").alias("d"))
        return s.keep(got.select("doc_id", "d.n_tokens", "d.ids_sha256", "d.decoded_sha256"), result=True)
