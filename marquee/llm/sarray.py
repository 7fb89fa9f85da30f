"""Exact substring deduplication with a logarithmic family of suffix indexes.

Every string of ``LENGTH`` bytes that starts in two places is found, without a
suffix for each byte:

1. *Sparse suffixes.* A window (a string of LENGTH bytes) picks its least
   32-byte gram by a hash, the leftmost of equals. Equal windows pick the same
   gram at the same place, so a repeated window makes a repeated gram. Each
   picked gram (about one in 85 bytes) is one suffix entry: the fingerprint of
   the gram, a fingerprint of all the text that its windows cover, and where.
2. *Index family.* Documents arrive in batches. A batch's distinct entries
   (gram and text), sorted by fingerprint, are its suffix array; it is
   merge-scanned (a sort-merge join of tables stored by that order) against
   each existing level, which gives the entries that occur on both sides, and
   then becomes a level itself. Levels of equal size are merged before the next
   batch, so sizes grow geometrically and a batch meets a logarithm of levels.
3. *Refinement.* An entry that occurs twice settles all its windows. One that
   occurs once, but whose gram has other texts, is split into runs of 16
   windows, and so is one row of each repeated entry of that gram; the runs are
   indexed in the same way by the bytes that a run's windows share. What is
   still open then is split into single windows.

An index row stands for all occurrences of one entry in its batch, so partial
aggregation shrinks a passage that a third of all documents share to one row a
task, and levels are stored by gram and text, which no frequent gram makes
uneven. Suffixes are ordered by fingerprint, not by alphabet: only
equality matters here. Grams and texts have 64-bit fingerprints each, and both
must agree; single windows have 128 bits.
"""

from __future__ import annotations


from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.common import Scratch, fresh, lean, shuffle_partitions, table

LENGTH, GRAM, RUN = 200, 32, 16
TILE = 1 << 17
PORTION = 1 << 14             # refined entries handed on together
ENTRY = "row long, batch int, at long, lo long, hi long, k1 long, k2 long, f long"
_SPREAD = np.random.default_rng(7).integers(0, 1 << 32, 256, dtype=np.uint32)
_MULT = {1: 0x9E3779B1, 2: 0x85EBCA77, 4: 0xC2B2AE3D, 8: 0x27D4EB2F, 16: 0x165667B1}


def anchors(buf: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gram, first window, last window) for the windows that ``valid`` marks
    (one flag for each start in ``buf``)."""
    x = _SPREAD[buf]
    for s, m in _MULT.items():
        x = x[:-s] * np.uint32(m) + x[s:]
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x2C1B3C6D)
    x ^= x >> np.uint32(13)
    m = (x.astype(np.uint64) << np.uint64(32)) | np.arange(len(x), dtype=np.uint64)
    width, todo = 1, LENGTH - GRAM + 1
    while width < todo:                                  # least of a sliding range, by doubling
        s = min(width, todo - width)
        m = np.minimum(m[:-s], m[s:])
        width += s
    p = np.flatnonzero(valid)
    if not len(p):
        return p, p, p
    a = (m[p] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    cut = np.flatnonzero(a[1:] != a[:-1]) + 1
    first = np.append(0, cut)
    return a[first], p[first], p[np.append(cut, len(p)) - 1]


def _signed(values: list[int]) -> np.ndarray:
    return np.array(values, dtype=np.uint64).view(np.int64)


def _tiles(rows, texts) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, row of each piece, where the piece starts here, where it starts
    in its document): short documents together, long ones in overlapping tiles."""
    parts, size, row, here, there = [], 0, [], [], []

    def done():
        return b"".join(parts), np.array(row), np.array(here), np.array(there)

    for r, t in zip(rows, texts):
        raw = t.encode("utf-8", "surrogatepass") if t else b""
        if len(raw) < LENGTH:
            continue
        for at in range(0, len(raw) - LENGTH + 1, TILE):
            piece = raw[at:at + TILE + LENGTH - 1]
            row.append(r)
            here.append(size)
            there.append(at)
            parts.append(piece)
            size += len(piece)
            if size >= TILE:
                yield done()
                parts, size, row, here, there = [], 0, [], [], []
    if parts:
        yield done()


def _batch(row, batches, at, lo, hi, k1, k2, f) -> pa.RecordBatch:
    row = np.asarray(row, dtype=np.int64)
    cols = [row, (row % batches).astype(np.int32), at, lo, hi, k1, k2, f]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=[x.split()[0] for x in ENTRY.split(", ")])


@lean
def _suffixes(it: Iterator[pa.RecordBatch], batches: int) -> Iterator[pa.RecordBatch]:
    """Sparse suffix entries of whole documents."""
    for b in it:
        for raw, row, here, there in _tiles(b.column(0).to_pylist(), (x.as_py() for x in b.column(1))):
            valid = np.zeros(max(0, len(raw) - LENGTH + 1), bool)
            for s, e in zip(here.tolist(), [*here[1:].tolist(), len(raw)]):
                valid[s:e - LENGTH + 1] = True
            a, lo, hi = anchors(np.frombuffer(raw, np.uint8), valid)
            if not len(a):
                continue
            key, text = xxhash.xxh3_64_intdigest, xxhash.xxh3_64_intdigest
            k1 = _signed([key(raw[i:i + GRAM]) for i in a.tolist()])
            f = _signed([text(raw[p:q + LENGTH], i - p) for i, p, q in zip(a.tolist(), lo.tolist(), hi.tolist())])
            j = np.searchsorted(here, lo, side="right") - 1
            move = there[j] - here[j]
            yield _batch(row[j], batches, a + move, lo + move, hi + move, k1, np.zeros(len(a), np.int64), f)


def _runs(raw: bytes, todo) -> Iterator[tuple]:
    """Entries of runs of windows: the key is what all windows of a whole run share."""
    for at, lo, hi in todo:
        for j in range((at - hi) // RUN, (at - lo) // RUN + 1):
            p, q = max(lo, at - RUN * j - RUN + 1), min(hi, at - RUN * j)
            core = raw[at - RUN * j:at - RUN * j - RUN + 1 + LENGTH]
            yield (at, p, q, xxhash.xxh3_64_intdigest(core, j), 0, xxhash.xxh3_64_intdigest(raw[p:q + LENGTH], at - p))


def _windows(raw: bytes, todo) -> Iterator[tuple]:
    for at, lo, hi in todo:
        for p in range(lo, hi + 1):
            k = xxhash.xxh3_128_intdigest(raw[p:p + LENGTH])
            yield at, p, p, k >> 64, k & 0xFFFFFFFFFFFFFFFF, k & 0xFFFFFFFFFFFFFFFF


@lean
def _refined(it: Iterator[pa.RecordBatch], split, batches: int) -> Iterator[pa.RecordBatch]:
    """Entries of what is split, a bounded number at a time, however many a text has."""
    def ready(rows: list, got: list) -> pa.RecordBatch:
        at, lo, hi, k1, k2, f = zip(*got)
        return _batch(rows, batches, np.array(at), np.array(lo), np.array(hi), _signed(k1), _signed(k2), _signed(f))

    rows, got = [], []
    for b in it:
        for k in range(b.num_rows):
            row, raw = b.column(0)[k].as_py(), b.column(1)[k].as_py().encode("utf-8", "surrogatepass")
            todo = b.column(2)[k].values
            places = zip(*(todo.field(c).to_pylist() for c in range(3)))
            for entry in split(raw, places):
                rows.append(row)
                got.append(entry)
                if len(got) == PORTION:
                    yield ready(rows, got)
                    rows, got = [], []
    if got:
        yield ready(rows, got)


KEY = ["k1", "k2", "f"]


class IndexFamily:
    """Levels of (k1, k2, f, n, r), each a table stored by its key; r is the first row."""

    def __init__(self, scratch: Scratch):
        self.scratch = scratch
        self.levels: list[tuple[int, DataFrame]] = []        # (batches it holds, table), largest first

    def add(self, entries: DataFrame) -> DataFrame:
        """Indexes a batch; gives (k1, k2, f, r) of entries that occur twice in
        it, or in it and in a level."""
        self._merge()
        own = self.scratch.bucketed(entries.groupBy(KEY).agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("r")), *KEY)
        found = own.where("n > 1").select(*KEY, "r")
        for _, level in self.levels:
            both = own.join(level.select(*KEY, F.col("r").alias("q")), KEY)
            found = found.unionByName(both.select(*KEY, F.least("r", "q").alias("r")))
        found = self.scratch.keep(found, "found")
        self.levels.append((1, own))
        return found

    def _merge(self) -> None:
        """Equal-sized levels become one of twice the size."""
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (n, a), (_, b) = self.levels.pop(), self.levels.pop()
            one = a.join(b.select(*KEY, F.col("n").alias("m"), F.col("r").alias("q")), KEY, "full").select(
                *KEY, (F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))).alias("n"), F.least("r", "q").alias("r"))
            merged = self.scratch.bucketed(one, *KEY)
            self.scratch.drop(a)
            self.scratch.drop(b)
            self.levels.append((2 * n, merged))

    def several(self) -> DataFrame:
        """(k1, k2) of grams that have more than one text."""
        union = None
        for _, level in self.levels:
            keys = level.select(*KEY)
            union = keys if union is None else union.unionByName(keys)
        return union.groupBy("k1", "k2").agg(F.min("f").alias("a"), F.max("f").alias("b")).where("a <> b").select("k1", "k2")


def repeated(entries: DataFrame, scratch: Scratch, batches: int, last: bool) -> DataFrame:
    """(row, at, lo, hi, done, todo): entries that occur twice are done; those
    whose gram has other texts too are to be split, of repeated ones one row."""
    family, found = IndexFamily(scratch), None
    for k in range(batches):
        new = family.add(entries.where(F.col("batch") == k))
        found = new if found is None else found.unionByName(new)
    twice = found.groupBy(KEY).agg(F.min("r").alias("r"))
    if last:
        out = entries.join(twice, KEY).select("row", "at", "lo", "hi", F.lit(True).alias("done"), F.lit(False).alias("todo"))
    else:
        twice = scratch.keep(twice, "twice")
        open_keys = scratch.keep(family.several(), "several")
        # entries that matter: all of a gram with several texts, and the repeated ones
        marked = entries.join(open_keys.withColumn("open", F.lit(True)), ["k1", "k2"], "left")
        marked = marked.join(twice, KEY, "left").where("open or r is not null")
        marked = scratch.keep(marked.select("row", "at", "lo", "hi", "k1", "k2", F.col("r").isNotNull().alias("done"),
                                            (F.coalesce("open", F.lit(False)) & (F.col("r").isNull() | (F.col("r") == F.col("row"))))
                                            .alias("todo")), "marked")
        # repeated entries are only split where some entry of the gram is still open
        # (stored first: a join of two plain shuffles can split a frequent gram)
        single = scratch.keep(marked.where("todo and not done").select("k1", "k2").distinct(), "single")
        out = marked.join(single.withColumn("single", F.lit(True)), ["k1", "k2"], "left").select(
            "row", "at", "lo", "hi", "done", (F.col("todo") & F.coalesce("single", F.lit(False))).alias("todo"))
    out = scratch.keep(out, "repeated")
    for _, level in family.levels:
        scratch.drop(level)
    return out


def numbered(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, str]:
    """``docs`` stored by a row number, and the number's column: from here on
    texts stay where they are and only positions move."""
    row = fresh(docs, "row_number")
    n = shuffle_partitions(docs.sparkSession)
    return scratch.bucketed(docs.withColumn(row, F.monotonically_increasing_id()).repartition(n, row), row), row


def repeated_spans(stored: DataFrame, row: str, text: str, scratch: Scratch, batches: int) -> DataFrame:
    """(row, lo, hi): runs of starts of windows that occur again anywhere."""
    spans, parts = None, batches
    entries = scratch.keep(stored.select(F.col(row), F.col(text)).mapInArrow(lambda it: _suffixes(it, batches), ENTRY),
                           "entries")
    for split in (_runs, _windows, None):
        hit = repeated(entries, scratch, parts, split is None)
        scratch.drop(entries)
        done = hit.where("done").select("row", "lo", "hi")
        spans = done if spans is None else spans.unionByName(done)
        if split is None:
            return spans
        todo = hit.where("todo").groupBy("row").agg(F.collect_list(F.struct("at", "lo", "hi")).alias("todo"))
        more = stored.select(F.col(row).alias("row"), F.col(text).alias("t")).join(todo, "row")
        entries = scratch.keep(more.select("row", "t", "todo").mapInArrow(
            lambda it, split=split: _refined(it, split, 1), ENTRY), "entries")
        parts = 1                   # what is split comes from all batches at once


def cut(raw: bytes, starts: list[tuple[int, int]]) -> tuple[bytes, list[tuple[int, int]]]:
    """What is left of ``raw`` without the windows that start in the given
    inclusive ranges, and the maximal removed [begin, end) runs."""
    runs: list[tuple[int, int]] = []
    for lo, hi in sorted(starts):
        if runs and lo <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(runs[-1][1], hi + LENGTH))
        else:
            runs.append((lo, hi + LENGTH))
    ends = [0, *(e for _, e in runs)]
    return b"".join(raw[e:s] for e, s in zip(ends, [*(s for s, _ in runs), len(raw)])), runs


CUT = "struct<n_bytes:bigint,n_removed:bigint,spans:array<struct<first:bigint,last:bigint>>,kept:binary>"


def _cutter():
    @F.pandas_udf(CUT)
    def one(texts: pd.Series, starts: pd.Series) -> pd.DataFrame:
        out = []
        for t, s in zip(texts, starts):
            raw = t.encode("utf-8", "surrogatepass") if t else b""
            kept, runs = cut(raw, [(int(x["lo"]), int(x["hi"])) for x in s] if s is not None else [])
            out.append((len(raw), len(raw) - len(kept), [{"first": a, "last": b} for a, b in runs], kept))
        return pd.DataFrame(out, columns=["n_bytes", "n_removed", "spans", "kept"])

    return one


def _text_cutter():
    """(text, first and last starts of removed windows) -> the text without them."""
    @F.pandas_udf("string")
    def one(texts: pd.Series, lo: pd.Series, hi: pd.Series) -> pd.Series:
        out = []
        for t, a, b in zip(texts, lo, hi):
            if t is not None and a is not None and len(a):
                t = cut(t.encode("utf-8", "surrogatepass"), list(zip(a.tolist(), b.tolist())))[0].decode("utf-8", "ignore")
            out.append(t)
        return pd.Series(out, dtype=object)

    return one


def _with_starts(docs: DataFrame, text: str, scratch: Scratch, batches: int) -> tuple[DataFrame, str, str]:
    """``docs`` with the starts of their repeated windows, and the names of that column and of the row's number."""
    stored, row = numbered(docs, scratch)
    spans = repeated_spans(stored, row, text, scratch, batches)
    starts = fresh(stored, "starts")
    lists = spans.groupBy(F.col("row").alias(row)).agg(F.collect_list(F.struct("lo", "hi")).alias(starts))
    return stored.join(lists, row, "left"), starts, row


def cut_repeats(docs: DataFrame, scratch: Scratch, text: str = "text", batches: int = 4) -> DataFrame:
    """``docs`` with the repeated strings cut out of ``text`` (see
    ``remove_repeats``); characters that a cut splits go with it. A null text
    stays null. One pass of Python over the texts."""
    joined, starts, row = _with_starts(docs, text, scratch, batches)
    c = F.col(starts)
    return joined.withColumn(text, _text_cutter()(F.col(text), c["lo"], c["hi"])).drop(row, starts)


def remove_repeats(docs: DataFrame, out: str, scratch: Scratch, text: str = "text", batches: int = 4) -> DataFrame:
    """``docs`` with a struct column ``out``: n_bytes, n_removed, spans (removed
    [first, last) byte runs) and kept (the remaining bytes).

    Removes each byte covered by a string of LENGTH bytes that also starts
    anywhere else, in the same document too; all copies go. Matches never
    cross documents and are judged on the input. Null and shorter texts lose
    nothing; repeated rows are copies of each other. All other columns stay;
    ``out`` must not be one of them. The result reads tables of ``scratch``.
    """
    joined, starts, row = _with_starts(docs, text, scratch, batches)
    return joined.withColumn(out, _cutter()(F.col(text), F.col(starts))).drop(row, starts)


def q_op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated strings cut out of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    with Scratch(spark, "op4") as s:
        c = F.col("cut")
        return s.keep(remove_repeats(docs, "cut", s).select(
            "doc_id", c["n_bytes"].alias("n_bytes"), c["n_removed"].alias("n_removed"),
            F.size(c["spans"]).cast("long").alias("n_spans"), F.sha2(c["kept"], 256).alias("kept_sha256")), result=True)
