"""Phrase collocations from count streams in prefix and suffix order.

1. *What can be frequent.* Each task counts the words and word pairs of a block
   of tokens with sorted arrays and hands on (64-bit key, count). Keys with
   ``LEAST`` occurrences or more set a bit in a filter of bounded size. The
   filter only saves work: a phrase of ``LEAST`` occurrences has no rarer part,
   so it always passes, whatever else collides with it.
2. *Count stream.* Phrases of 1 to 4 words whose words and pairs all pass are
   counted by their text, first in the block, then by Spark; those of ``LEAST``
   or more occurrences are the stream. All parts of its phrases are in it.
3. *Prefix and suffix order.* The stream is sorted twice, by words and by words
   from the last. In prefix order a phrase comes after its own first parts, so
   one forward scan with a stack of at most 4 gives their counts; in suffix
   order the same scan gives the counts of the last parts. A scan also sees
   whether a phrase covers the one it extends by a word, which needs no more
   than that: what covers a phrase from further out covers it through such a
   step. The two results, sorted by phrase, are merge-joined.
4. Scores, and positions in a total order, which has no single-task step.

Sorted runs are cut at any row, also inside a frequent first word: the few
parts that a run's first row lacks (at most 3) are put before it.
"""

from __future__ import annotations

import collections
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.common import Scratch, lean, shuffle_partitions, table
from marquee.llm.shingles import mix
from marquee.operators.order import with_position

LEAST, LONGEST, COVER, TOP = 30, 4, 80, 2000
#: Tokens counted together in a task, and bytes of a text split into words at a time.
BLOCK, SLICE = 1 << 20, 1 << 18
#: Most bits of the filter (2^28: 32 MiB), and bits for each key while it is smaller.
MAX_BITS, BITS_PER_KEY = 28, 64
_CHUNK = 16                         # bits of the filter gathered as one row

#: A-Z to lower case, piece ends to a byte that no UTF-8 text has, tabs to spaces.
_END = b"\xff"
_BYTES = bytearray(range(256))
_BYTES[65:91] = range(97, 123)
for _c in b".,;:!?\x0a\x0b\x0c\x0d":
    _BYTES[_c] = _END[0]
_BYTES[9] = 32
_BYTES = bytes(_BYTES)


def tokens(raw: bytes) -> Iterator[list[bytes]]:
    """Words and piece ends of a text, a slice at a time."""
    raw, at = raw.translate(_BYTES), 0
    while at < len(raw):
        to = len(raw)
        if to - at > SLICE:
            to = raw.find(b" ", at + SLICE)
            to = to if to >= 0 else len(raw)
        yield raw[at:to].replace(_END, b" \xff ").split()
        at = to


class Block:
    """Word numbers of a run of texts in one language; 0 ends a piece."""

    def __init__(self, lang: str):
        self.lang, self.parts, self.size = lang, [], 0
        self.number = collections.defaultdict()
        self.number.default_factory = self.number.__len__
        self.number[_END]

    def add(self, raw: bytes) -> None:
        for t in tokens(raw):
            self.parts.append(np.fromiter(map(self.number.__getitem__, t), np.int32, len(t)))
            self.size += len(t)
        self.parts.append(np.zeros(1, np.int32))

    def numbers(self) -> np.ndarray:
        return np.concatenate(self.parts).astype(np.int64)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word, other ones in each language."""
        seed = xxhash.xxh3_64_intdigest(self.lang.encode())
        return np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in self.number), np.uint64, len(self.number))


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(29))))


def _blocks(it: Iterator[pa.RecordBatch], size: int) -> Iterator[Block]:
    """(lang, text) rows as blocks of at least ``size`` tokens in all; the last ones may be smaller."""
    open_blocks: dict[str, Block] = {}
    n = 0
    for b in it:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary())):
            raw = text.as_py()
            if not raw:
                continue
            block = open_blocks.get(lang)
            if block is None:
                block = open_blocks[lang] = Block(lang)
            n -= block.size
            block.add(raw)
            n += block.size
            if n >= size:
                yield from open_blocks.values()
                open_blocks, n = {}, 0
    yield from open_blocks.values()


@lean
def _keys(it: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """(key, n) of the words and pairs in each block."""
    for block in _blocks(it, size):
        a, h = block.numbers(), block.hashes()
        wide = len(h)
        one = np.bincount(a, minlength=wide)[1:]
        pairs = a[:-1] * wide + a[1:]
        pairs, two = np.unique(pairs[(a[:-1] > 0) & (a[1:] > 0)], return_counts=True)
        yield from _key_rows(mix(h[1:]), one)
        for i, j in _slices(len(pairs)):
            yield from _key_rows(_pair(h[pairs[i:j] // wide], h[pairs[i:j] % wide]), two[i:j])


def _key_rows(keys: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    for i, j in _slices(len(keys)):
        yield pa.RecordBatch.from_arrays([pa.array(keys[i:j].view(np.int64)), pa.array(n[i:j], pa.int64())], names=["key", "n"])


def _slices(n: int, step: int = 1 << 16) -> Iterator[tuple[int, int]]:
    for i in range(0, n, step):
        yield i, min(i + step, n)


class Filter:
    """A bit for each key modulo its size."""

    def __init__(self, bits: int, words: np.ndarray):
        self.mask, self.words = np.uint64((1 << bits) - 1), words

    def has(self, keys: np.ndarray) -> np.ndarray:
        slot = keys & self.mask
        return (self.words[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _filter(frequent: DataFrame) -> tuple[int, np.ndarray]:
    """Bits set for the keys; at most 2^MAX_BITS of them come to the driver, whatever the number of keys."""
    n = frequent.count()
    bits = min(MAX_BITS, max(_CHUNK, math.ceil(math.log2(1 + n * BITS_PER_KEY))))

    def gather(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        flags = np.zeros(1 << _CHUNK, bool)
        flags[pdf["slot"].to_numpy() & ((1 << _CHUNK) - 1)] = True
        return pd.DataFrame({"chunk": [key[0]], "bits": [np.packbits(flags, bitorder="little").tobytes()]})

    slots = frequent.select(F.col("key").bitwiseAND((1 << bits) - 1).alias("slot")).distinct()
    chunks = slots.groupBy(F.shiftright("slot", _CHUNK).alias("chunk")).applyInPandas(gather, "chunk long, bits binary")
    words, step = np.zeros((1 << bits) // 8, np.uint8), (1 << _CHUNK) // 8
    for row in chunks.collect():
        words[row["chunk"] * step:(row["chunk"] + 1) * step] = np.frombuffer(row["bits"], np.uint8)
    return bits, words


@lean
def _phrases(it: Iterator[pa.RecordBatch], size: int, longest: int, shared) -> Iterator[pa.RecordBatch]:
    """(lang, phrase, n) of what may be frequent in each block; phrase null: all words."""
    known = Filter(*shared.value)
    for block in _blocks(it, size):
        a, h = block.numbers(), block.hashes()
        wide, words = len(h), list(block.number)
        one = np.bincount(a, minlength=wide)
        some = known.has(mix(h))
        some[0] = False
        at = np.flatnonzero(some)
        yield from _phrase_rows(block.lang, [None], np.array([one[1:].sum()]))
        yield from _phrase_rows(block.lang, [words[i] for i in at.tolist()], one[at])
        where = np.flatnonzero(some[a[:-1]] & some[a[1:]])
        both = [known.has(_pair(h[a[where[i:j]]], h[a[where[i:j] + 1]])) for i, j in _slices(len(where))]
        where = where[np.concatenate([np.zeros(0, bool), *both])]
        pairs, pair_at, n = np.unique(a[where] * wide + a[where + 1], return_inverse=True, return_counts=True)
        ends = (pairs % wide).tolist()
        runs = [words[i] + b" " + words[j] for i, j in zip((pairs // wide).tolist(), ends)]
        yield from _phrase_rows(block.lang, runs, n)
        # a run of m words is one of m - 1 words and the pair that begins at the last of them
        pair = np.full(len(a) + longest, -1, np.int32)
        pair[where] = pair_at
        got, width = pair_at, max(1, len(pairs))
        for length in range(2, longest):
            last = pair[where + length - 1]
            where, got, last = where[last >= 0], got[last >= 0], last[last >= 0]
            key, got, n = np.unique(got * width + last, return_inverse=True, return_counts=True)
            runs = [runs[i] + b" " + words[ends[j]] for i, j in zip((key // width).tolist(), (key % width).tolist())]
            yield from _phrase_rows(block.lang, runs, n)


def _phrase_rows(lang: str, phrases: list[bytes | None], n: np.ndarray) -> Iterator[pa.RecordBatch]:
    for i, j in _slices(len(phrases)):
        yield pa.RecordBatch.from_arrays([pa.array([lang] * (j - i), pa.string()), pa.array(phrases[i:j], pa.binary()).cast(pa.string()),
                                          pa.array(n[i:j], pa.int64())], names=["lang", "phrase", "n"])


def count_stream(texts: DataFrame, scratch: Scratch, least: int = LEAST, longest: int = LONGEST,
                 block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, f) of all phrases of 1 to ``longest`` words with ``least``
    occurrences or more, and (lang, n), all words of each language."""
    spark = texts.sparkSession
    keys = texts.mapInArrow(lambda it: _keys(it, block), "key long, n long")
    frequent = scratch.keep(keys.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("key"), "frequent")
    shared = spark.sparkContext.broadcast(_filter(frequent))
    found = texts.mapInArrow(lambda it: _phrases(it, block, longest, shared), "lang string, phrase string, n long")
    counted = scratch.keep(found.groupBy("lang", "phrase").agg(F.sum("n").alias("f")).where(f"phrase is null or f >= {least}"), "stream")
    return counted.where("phrase is not null"), counted.where("phrase is null").select("lang", F.col("f").alias("n"))


SCANNED = "lang string, words array<string>, f long, parts array<long>, covers boolean"


@lean
def _scan(it: Iterator[pa.RecordBatch], cover: int) -> Iterator[pa.RecordBatch]:
    """Rows (run, own, lang, words, f) in order; gives each own phrase of two or
    more words with the counts of its first 1, 2, ... words, and whether it
    covers its first words but one."""
    now, stack = None, []
    for b in it:
        out = []
        for run, own, lang, words, f in zip(*(c.to_pylist() for c in b.columns)):
            if (run, lang) != now:
                now, stack = (run, lang), []
            m = len(words)
            del stack[m - 1:]
            if [w for w, _ in stack] != words[:-1]:
                raise RuntimeError(f"the stream lacks a part of {words}")
            if own and m > 1:
                parts = [n for _, n in stack]
                out.append((lang, words, f, parts, m > 2 and 100 * f >= cover * parts[-1]))
            stack.append((words[-1], f))
        if out:
            cols = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.list_(pa.string())), pa.array(cols[2], pa.int64()),
                 pa.array(cols[3], pa.list_(pa.int64())), pa.array(cols[4], pa.bool_())],
                names=["lang", "words", "f", "parts", "covers"])


def scan_parts(stream: DataFrame, scratch: Scratch, cover: int) -> DataFrame:
    """The scan over (lang, words, f) in the order of the words, in sorted runs of about equal size."""
    n = shuffle_partitions(stream.sparkSession)
    runs = stream.repartitionByRange(n, "lang", "words")
    runs = scratch.keep(runs.withColumn("run", F.spark_partition_id()), "runs")
    first = runs.groupBy("run").agg(F.min(F.struct("lang", "words")).alias("x"))
    lacks = first.select("run", F.col("x.lang").alias("lang"), F.col("x.words").alias("w"),
                         F.explode(F.expr("case when size(x.words) > 1 then sequence(1, size(x.words) - 1) end")).alias("m"))
    lacks = lacks.select("run", "lang", F.expr("slice(w, 1, m)").alias("words")).join(runs.drop("run"), ["lang", "words"])
    rows = runs.select("run", F.lit(True).alias("own"), "lang", "words", "f").unionByName(
        lacks.select("run", F.lit(False).alias("own"), "lang", "words", "f"))
    rows = rows.repartition(n, "run").sortWithinPartitions("run", "lang", "words")
    return scratch.keep(rows.mapInArrow(lambda it: _scan(it, cover), SCANNED), "scanned")


def mine(docs: DataFrame, scratch: Scratch, text: str = "text", lang: str = "lang", least: int = LEAST,
         longest: int = LONGEST, cover: int = COVER, top: int = TOP, block: int = BLOCK) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases.

    Words are lower-cased (A-Z), runs of anything but space and tab inside
    pieces that ``. , ; : ! ?`` and line ends part. A phrase has 2 to
    ``longest`` words and ``least`` occurrences (a) or more, overlapping ones
    included; its score is floor(2000000 a / (l + r)) for the cut into a first
    part (l occurrences) and a rest (r) that scores lowest, of equals the
    shortest first part. Phrases inside a longer one with at least ``cover`` per
    cent of their occurrences are left out. Order: score, a, then phrase by
    bytes, so ties have one order. Null and empty texts have no words, a null
    language is ``und``, repeated rows count each time, an empty table gives no
    row; other columns are not read. The result reads tables of ``scratch``."""
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    counted, words = count_stream(texts, scratch, least, longest, block)
    stream = counted.select("lang", F.split("phrase", " ").alias("words"), "f")
    before = scan_parts(stream, scratch, cover)
    after = scan_parts(stream.withColumn("words", F.reverse("words")), scratch, cover)
    after = after.withColumn("words", F.reverse("words"))
    joined = before.select("lang", F.array_join("words", " ").alias("phrase"), F.col("f").alias("a"), F.col("parts").alias("first")).join(
        after.select("lang", F.array_join("words", " ").alias("phrase"), F.col("parts").alias("rest")).hint("merge"), ["lang", "phrase"])
    covered = before.where("covers").select("lang", F.expr("array_join(slice(words, 1, size(words) - 1), ' ')").alias("phrase")).unionByName(
        after.where("covers").select("lang", F.expr("array_join(slice(words, 2, size(words) - 1), ' ')").alias("phrase")))
    open_ones = joined.join(covered.hint("merge"), ["lang", "phrase"], "left_anti")
    # a product may pass 64 bits: decimals are exact
    best = F.expr("""array_min(transform(sequence(1, size(first)), k -> named_struct(
        'score', cast(2000000 as decimal(7,0)) * cast(a as decimal(19,0))
                 div cast(first[k - 1] + rest[size(first) - k] as decimal(20,0)),
        'k', k, 'l', first[k - 1], 'r', rest[size(first) - k])))""")
    scored = scratch.keep(open_ones.withColumn("x", best).select("lang", "phrase", "a", F.col("x.l").alias("l"), F.col("x.r").alias("r"),
                                                                 F.col("x.score").alias("score")), "scored")
    ranked = with_position(scored, [F.desc("score"), F.desc("a"), F.asc("phrase")], scratch.path("ranked"), ["lang"], "rank")
    return ranked.where(F.col("rank") <= top).join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def q_op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collocations of all documents, by language."""
    docs = table(spark, sf_dir, "documents").select("lang", "text")
    with Scratch(spark, "op13") as s:
        return s.keep(mine(docs, s), result=True)
