"""Token ids as directly addressable codes.

An id is split into chunks of 8 bits. Level 0 holds the lowest chunk of every
id and a bitmap that says which ids go on; level 1 holds the next chunk of
those, and so on. Set bits before a position (a directory entry per 512 bits,
then a count inside) give an id's place in the next level, so any id is read
from one chunk a level, without decoding a block. The ids of a range are
consecutive on every level, so a range is a few array slices.

A store is a folder: ``segments`` (a Parquet table whose ``dac`` column holds
one coded run of whole documents) and ``parts`` (where each ordered part of
the segments begins). Spark's writers commit both, on any store.
"""

from __future__ import annotations

import functools
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.llm.common import Scratch, shuffle_partitions, table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
MAGIC, BITS, STEP = b"DAC1", 8, 512
_ONES = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)


def encode_dac(ids: np.ndarray) -> bytes:
    """Levels, bitmaps and rank directories of unsigned 32-bit ids."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        more = rest >> np.uint32(BITS)
        go_on = more > 0
        bits = np.packbits(go_on, bitorder="little")
        pad = np.zeros(-(-len(rest) // STEP) * (STEP // 8), np.uint8)
        pad[: len(bits)] = bits
        rank = np.append(0, np.cumsum(_ONES[pad].reshape(-1, STEP // 8).sum(axis=1, dtype=np.int64))).astype("<u4")
        levels.append(struct.pack("<Q", len(rest)) + (rest & np.uint32((1 << BITS) - 1)).astype(np.uint8).tobytes()
                      + pad.tobytes() + rank.tobytes())
        rest = more[go_on]
        if not len(rest):
            return MAGIC + struct.pack("<BB", BITS, len(levels)) + b"".join(levels)


class Dac:
    """Random access to the ids of ``encode_dac``."""

    def __init__(self, blob: bytes):
        if blob[:4] != MAGIC:
            raise ValueError("not a DAC1 segment")
        _, n_levels = struct.unpack_from("<BB", blob, 4)
        at, self.levels = 6, []
        for _ in range(n_levels):
            (n,) = struct.unpack_from("<Q", blob, at)
            blocks = -(-n // STEP)
            at += 8
            data = np.frombuffer(blob, np.uint8, n, at)
            bits = np.frombuffer(blob, np.uint8, blocks * (STEP // 8), at + n)
            rank = np.frombuffer(blob, "<u4", blocks + 1, at + n + len(bits))
            at += n + len(bits) + 4 * (blocks + 1)
            self.levels.append((data, bits, rank))

    def __len__(self) -> int:
        return len(self.levels[0][0])

    @staticmethod
    def _rank(bits: np.ndarray, rank: np.ndarray, i: int) -> int:
        """Set bits before ``i``."""
        block, byte = i // STEP, i >> 3
        n = int(rank[block]) + int(_ONES[bits[block * (STEP // 8):byte]].sum())
        return n + (int(_ONES[bits[byte] & ((1 << (i & 7)) - 1)]) if i & 7 else 0)

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < len(self):
            raise IndexError(i)
        out = 0
        for k, (data, bits, rank) in enumerate(self.levels):
            out |= int(data[i]) << (BITS * k)
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            i = self._rank(bits, rank, i)
        return out

    def slice(self, i: int, j: int) -> np.ndarray:
        """The ids from ``i`` to before ``j``."""
        out = np.zeros(j - i, "<u4")
        where = np.arange(j - i)
        for k, (data, bits, rank) in enumerate(self.levels):
            if i >= j:
                break
            out[where] |= data[i:j].astype("<u4") << np.uint32(BITS * k)
            go_on = np.unpackbits(bits[i >> 3:(j + 7) >> 3], bitorder="little")[i & 7:][: j - i].astype(bool)
            where = where[go_on]
            i, j = self._rank(bits, rank, i), self._rank(bits, rank, j) if j < len(data) else int(rank[-1])
        return out


# ---------------------------------------------------------------- tokenizing

#: Letters that every Unicode version knows, the marks that may follow a word (no apostrophe, which contractions have), one line end.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_PLAIN = re.compile(f"([{_LETTERS}]+)([!-&(-/:-@[-`{{-~]*)(?:(\n)([{_LETTERS}].*))?", re.DOTALL)


class _Words(dict):
    """Ids (as bytes) of space-separated units, each asked of the library once.

    A position between a visible character and a space is always a boundary of
    the tokenizer's pre-tokens, so units are encoded on their own; so is one
    between a letter and a mark, and around a single line end between visible
    characters, so a word is asked for without the marks after it. At
    ``limit`` units a new generation begins and the last but one is dropped:
    that bounds the memory, not the result."""

    def __init__(self, encoder, prefix: str, limit: int = 500_000):
        super().__init__()
        self.encoder, self.prefix, self.limit, self.before = encoder, prefix, limit, {}

    def __missing__(self, unit: str) -> bytes:
        ids = self.before.get(unit)
        if ids is None:
            m = None
            if unit.isascii() and unit.isalpha():
                ids = self.encoder.ask_word(unit, self.prefix)
            elif (m := _PLAIN.fullmatch(unit)) is None:
                ids = self.encoder.ask(self.prefix + unit)
            else:
                word, marks, line, rest = m.groups()
                if not marks and not line:
                    ids = self.encoder.ask_word(word, self.prefix)
                else:
                    plain = self.encoder.plain
                    ids = self[word] + (plain[marks] if marks else b"")
                    if line:                # seldom seen again
                        return ids + plain[line] + plain[rest]
        if len(unit) <= 64:
            if len(self) >= self.limit:
                self.before = dict(self)
                self.clear()
            self[unit] = ids
        return ids


_ODD = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S)(?= )")


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.encode_special_tokens = True          # their strings in a text are ordinary text
        self.tokenizer, self.model = t, t.model
        letters = "".join(chr(c) for c in range(0x250)) + " "
        # how the tokenizer's byte-level step writes a byte, asked of the step itself
        self.spell = {b: t.pre_tokenizer.pre_tokenize_str(chr(b))[0][0] for b in range(0x21, 0x7F)}
        self.spell |= {c.encode()[-1]: t.pre_tokenizer.pre_tokenize_str(c)[0][0][-1] for c in letters if len(c.encode()) == 2}
        self.spell |= {c.encode()[0]: t.pre_tokenizer.pre_tokenize_str(c)[0][0][0] for c in letters if len(c.encode()) == 2}
        self.spell[32] = t.pre_tokenizer.pre_tokenize_str(" a")[0][0][0]
        self.packed = [struct.pack("<I", i) for i in range(t.get_vocab_size())]
        self.spaced, self.plain = _Words(self, " "), _Words(self, "")

    def ask(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def ask_word(self, word: str, prefix: str) -> bytes:
        """A run of letters (with its space) is one pre-token: only the merges are asked for."""
        spelt = (self.spell[32] if prefix else "") + (
            word if word.isascii() else word.encode().decode("latin-1").translate(self.spell))
        packed = self.packed
        return b"".join([packed[x.id] for x in self.model.tokenize(spelt)])

    def __call__(self, text: str) -> bytes:
        """The ids of the whole text, little-endian unsigned 32-bit."""
        if not text:
            return b""
        if _ODD.search(text) or text[0] == " ":
            return b"".join(map(self.plain.__getitem__, _CUT.split(text)))
        first, *rest = text.split(" ")
        return self.plain[first] + b"".join(map(self.spaced.__getitem__, rest))


@functools.cache
def encoder(path: str = TOKENIZER) -> Encoder:
    return Encoder(path)


# ------------------------------------------------------------ write and read

#: Positions with one key when they look for their segments.
COARSE = 1 << 20
SEGMENT = "part int, seq int, first long, n long, doc_ids array<bigint>, starts array<bigint>, dac binary"


def _segments(batches: Iterator[pa.RecordBatch], path: str, end_id: int, size: int) -> Iterator[pa.RecordBatch]:
    """Coded runs of at least ``size`` ids (the last of a part: fewer); a document is never split."""
    enc, end = encoder(path), np.array([end_id], "<u4").tobytes()
    part, seq, first = TaskContext.get().partitionId(), 0, 0
    ids, starts, data, n = [], [], [], 0

    def flush():
        blob = encode_dac(np.frombuffer(b"".join(data), "<u4"))
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([first], pa.int64()),
             pa.array([n], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([starts], pa.list_(pa.int64())),
             pa.array([blob], pa.binary())], names=["part", "seq", "first", "n", "doc_ids", "starts", "dac"])

    for b in batches:
        for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
            got = enc(text.as_py() or "") + end
            ids.append(doc)
            starts.append(n)
            data.append(got)
            n += len(got) // 4
            if n >= size:
                yield flush()
                seq, first = seq + 1, first + n
                ids, starts, data, n = [], [], [], 0
    if ids:
        yield flush()


def write_tokens(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER,
                 end_id: int = 2, segment: int = 1 << 20) -> None:
    """Encodes whole texts in ascending id order (null ids first, equal ids by
    a hash of the text) and writes the store. A null or empty text is its end
    id alone; repeated rows are written each; other columns are not read.
    Equal ids may spread over several parts, so a hot id makes no hot task."""
    spark = docs.sparkSession
    d = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    keys = [F.col("id"), F.col("h"), F.col("r")]
    d = d.withColumns({"h": F.xxhash64("text"), "r": F.monotonically_increasing_id()})
    d = d.repartitionByRange(shuffle_partitions(spark), *keys).sortWithinPartitions(*keys).select("id", "text")
    seg = d.mapInArrow(lambda it: _segments(it, tokenizer, end_id, segment), SEGMENT)
    seg.write.option("compression", "none").parquet(f"{path}/segments")
    totals = spark.read.parquet(f"{path}/segments").groupBy("part").agg(F.sum("n").alias("n"))
    w = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)        # a row for each part
    totals.select("part", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("base")).write.parquet(f"{path}/parts")


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """The segments with ``start``, the number of ids before each."""
    seg = spark.read.schema(SEGMENT).parquet(f"{path}/segments")
    base = spark.read.schema("part int, base long").parquet(f"{path}/parts")
    return seg.join(base, "part").withColumn("start", F.col("base") + F.col("first")).drop("base", "first")


def tokens_at(spark: SparkSession, path: str, positions: DataFrame, at: str = "at") -> DataFrame:
    """(at, id) for positions in the whole store; positions outside give no row."""
    seg = read_segments(spark, path)
    p = positions.select(F.col(at).cast("long").alias("at")).distinct()

    def pick(batches):
        for b in batches:
            for k in range(b.num_rows):
                start, at, blob = (b.column(c)[k].as_py() for c in range(3))
                dac = Dac(blob)
                yield pa.RecordBatch.from_arrays([pa.array([start + i for i in at], pa.int64()), pa.array([dac[i] for i in at], pa.int64())],
                                                 names=["at", "id"])

    # positions meet the bounds of segments by a coarse key; a segment is then opened once for all of its positions
    bounds = seg.select("part", "seq", "start", "n", F.explode(F.sequence(F.expr(f"start div {COARSE}"), F.expr(f"(start + n - 1) div {COARSE}"))).alias("c"))
    own = p.withColumn("c", F.expr(f"at div {COARSE}")).join(bounds, "c").where("at >= start and at < start + n")
    lists = own.groupBy("part", "seq").agg(F.collect_list(F.col("at") - F.col("start")).alias("at"))
    return lists.join(seg.select("part", "seq", "start", "dac"), ["part", "seq"]).select("start", "at", "dac").mapInArrow(pick, "at long, id long")


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for start, n, ids, starts, blob in zip(*(c.to_pylist() for c in b.columns)):
            dac = Dac(blob)
            run = memoryview(dac.slice(0, n)).cast("B")             # all documents are read: the segment's ids at once
            for doc, i, j in zip(ids, starts, [*starts[1:], n]):
                out.append((doc, start + i, j - i, zlib.crc32(run[4 * i:4 * j])))
        cols = list(zip(*out)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                         names=["doc_id", "start", "n_tokens", "ids_crc32"])


def q_op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids written to a store and read back from it."""
    docs = table(spark, sf_dir, "documents")
    with Scratch(spark, "op8") as s:
        path = s.path("store")
        write_tokens(docs, path)
        seg = read_segments(spark, path).select("start", "n", "doc_ids", "starts", "dac")
        return s.keep(seg.mapInArrow(_documents, "doc_id long, start long, n_tokens long, ids_crc32 long"), result=True)
