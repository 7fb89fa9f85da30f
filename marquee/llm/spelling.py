"""Spelling variants by blocked Gram matrices of letter counts.

Two words that differ by one inserted, deleted or replaced letter have letter
counts at a squared distance of at most two and lengths at most one apart. So:

1. *Words.* Runs of letters are counted in each task, then by Spark.
2. *Blocks.* Letters fall into a few groups. Words of one length with the same
   counts by group are a cell; near words lie in one cell, or in two whose
   counts differ by one letter moved to another group or added. A cell is cut
   by hash into blocks of bounded size, however many words it holds.
3. *Gram matrices.* For a pair of blocks of neighbouring cells a product of the
   two letter-count matrices (with the squared norms as further columns) is the
   matrix of squared distances. Pairs at two or less are verified on their
   letters: exactly one place replaced, or one letter more.
4. A block pair hands on, for each word, the number of near words and the best
   of them, which Spark puts together: no list of pairs is ever made.
5. *Roots.* Forms lead from word to word with at least five times as many
   occurrences each time, so chains are short; pointers are doubled along them.

The number of groups follows the number of words, so that cells stay small
while the vocabulary grows; it changes the work, not the result.
"""

from __future__ import annotations

import collections
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.common import ASCII_LOWER, Scratch, shuffle_partitions, table

SHORTEST, LEAST, TIMES = 6, 5, 5
#: Every how many runs (by hash) one letter is taken out, as the contract plants variants.
DROP_EVERY = 199
#: Letters by how often texts of these languages use them, most frequent first.
LETTERS = "eaisnrtoludcmphgbvfqyxjkzw" + "".join(map(chr, range(0xE0, 0x100))) + "".join(map(chr, range(0xC0, 0xE0)))
#: Words of a block, and bytes of a block of very long words.
ROWS, BYTES = 1024, 1 << 20
#: Most distinct words that a task holds before it hands them on.
HELD = 400_000
_COLUMN = np.full(256, len(LETTERS), np.int64)
_COLUMN[np.frombuffer(LETTERS.encode("latin-1"), np.uint8)] = np.arange(len(LETTERS))


def variant(doc_id: str, run: str, every: int = DROP_EVERY) -> str:
    """``run`` without one code point where the hash of the document and the run says so."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if every and h % every == 0:
        at = h % len(run)
        return run[:at] + run[at + 1:]
    return run


def _counts(it: Iterator[pa.RecordBatch], shortest: int, every: int) -> Iterator[pa.RecordBatch]:
    """(word, n) of whole texts, in portions."""
    runs = re.compile(f"[a-zÀ-ÿ]{{{shortest},}}")        # a shorter run gives no word
    total: collections.Counter[str] = collections.Counter()

    def portion() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())],
                                         names=["word", "n"])
        total.clear()
        return out

    for b in it:
        for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary())):
            raw = text.as_py()
            if not raw:
                continue
            found = collections.Counter(runs.findall(raw.translate(ASCII_LOWER).decode("utf-8", "replace")))
            for run, n in found.items():
                word = variant(doc_id, run, every)
                if len(word) >= shortest:
                    total[word] += n
            if len(total) >= HELD:
                yield portion()
    yield portion()


def count_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shortest: int = SHORTEST, least: int = LEAST,
                every: int = DROP_EVERY) -> DataFrame:
    """(word, n) of words with ``least`` occurrences or more."""
    d = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.col(text))
    found = d.mapInArrow(lambda it: _counts(it, shortest, every), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def n_groups(n_words: int) -> int:
    """Letter groups for a vocabulary: one more for each doubling from 2^17 words on, 3 to 16."""
    return min(16, max(3, round(math.log2(1 + n_words)) - 14))


def _cell(groups: int):
    """Letters of a word by group, as an array of counts."""
    members = ["".join(LETTERS[g::groups]) for g in range(groups)]
    return F.array(*[F.length("word") - F.length(F.translate("word", m, "")) for m in members])


def _moves(groups: int) -> list[list[int]]:
    """What must be added to a cell's counts for those of its neighbours, of each pair of cells one way."""
    same = [[0] * groups]
    for i in range(groups):
        for j in range(i + 1, groups):
            same.append([(k == i) - (k == j) for k in range(groups)])
    return same + [[int(k == i) for k in range(groups)] for i in range(groups)]


def _letters(blob: bytes, length: int) -> np.ndarray:
    return np.frombuffer(blob, np.uint8).reshape(-1, length)


def _vectors(letters: np.ndarray) -> np.ndarray:
    """Letter counts of each word."""
    v = np.zeros((len(letters), len(LETTERS) + 1), np.float32)
    rows = np.arange(len(letters))
    for column in _COLUMN[letters.T]:
        v[rows, column] += 1
    return v


def close_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of two letter matrices whose letter counts are at a squared distance of two or less."""
    va, vb = _vectors(a), _vectors(b)
    na, nb = (va * va).sum(axis=1), (vb * vb).sum(axis=1)
    one_a, one_b = np.ones((len(a), 1), np.float32), np.ones((len(b), 1), np.float32)
    # counts of very long words pass what a 32-bit float holds exactly
    kind = np.float32 if max(a.shape[1], b.shape[1]) < 2000 else np.float64
    left = np.hstack((va * -2, na[:, None], one_a)).astype(kind)
    right = np.hstack((vb, one_b, nb[:, None])).astype(kind)
    if kind is np.float64:
        left[:, -2], right[:, -1] = (va.astype(kind) ** 2).sum(axis=1), (vb.astype(kind) ** 2).sum(axis=1)
    hit = np.flatnonzero((left @ right.T).ravel() <= 2.5)
    return hit // len(b), hit % len(b)


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether each row of ``a`` and the same row of ``b`` differ by exactly one
    replaced letter (equal lengths), or ``b`` has one letter more."""
    n, m = a.shape[1], b.shape[1]
    if n == m:
        return (a != b).sum(axis=1) == 1
    head, tail = a == b[:, :-1], a == b[:, 1:]
    # letters that agree from the front, and from the back
    front = np.where(head.all(axis=1), n, head.argmin(axis=1))
    back = np.where(tail.all(axis=1), n, tail[:, ::-1].argmin(axis=1))
    return front + back >= n


PARTIAL = "word string, n_near long, best_n long, best string"


def _near(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Block pairs (length, blob, n, same, length, blob, n) -> each word's near words, summed up."""
    for b in it:
        words, near, best_n, best = [], [], [], []
        for row in range(b.num_rows):
            la, blob_a, same, lb, blob_b = (b.column(k)[row].as_py() for k in (0, 1, 3, 4, 5))
            x, y = _letters(blob_a, la), _letters(blob_b, lb)
            i, j = close_pairs(x, y)
            if same:                            # a block with itself: each pair once
                i, j = i[i < j], j[i < j]
            if len(i):
                ok = one_edit(x[i], y[j])
                i, j = i[ok], j[ok]
            if not len(i):
                continue
            n_a, n_b = (b.column(k)[row].values.to_numpy(zero_copy_only=False) for k in (2, 6))
            for p, q, u, v, size, other in ((i, j, x, y, n_a, n_b), (j, i, y, x, n_b, n_a)):
                # a block's words are in code-point order, so of equals the first row is the least word
                order = np.lexsort((q, -other[q], p))
                p, q = p[order], q[order]
                first = np.flatnonzero(np.append(True, p[1:] != p[:-1]))
                words += [u[k].tobytes().decode("latin-1") for k in p[first].tolist()]
                best += [v[k].tobytes().decode("latin-1") for k in q[first].tolist()]
                near += np.diff(np.append(first, len(p))).tolist()
                best_n += other[q[first]].tolist()
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(near, pa.int64()), pa.array(best_n, pa.int64()),
                                          pa.array(best, pa.string())], names=["word", "n_near", "best_n", "best"])


def near_words(words: DataFrame, scratch: Scratch, groups: int | None = None) -> DataFrame:
    """(word, n_near, best_n, best) of words (word, n) that have a near word;
    best: the near word of largest n, of equals the first in code-point order."""
    groups = groups or n_groups(words.count())
    parts = shuffle_partitions(words.sparkSession)
    w = words.withColumns({"length": F.length("word"), "cell": _cell(groups)})
    cells = w.groupBy("cell", "length").agg(F.count(F.lit(1)).alias("size"))
    rows = F.greatest(F.lit(1), F.least(F.lit(ROWS), F.floor(F.lit(BYTES) / F.col("length"))))
    cells = scratch.keep(cells.select("cell", "length", F.ceil(F.col("size") / rows).cast("int").alias("blocks")), "cells")
    dealt = w.join(cells, ["cell", "length"]).withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    packed = dealt.groupBy("cell", "length", "block").agg(F.array_sort(F.collect_list(F.struct("word", "n"))).alias("w"))
    packed = scratch.keep(packed.select(
        "cell", "length", "block", F.encode(F.array_join("w.word", ""), "ISO-8859-1").alias("blob"), F.col("w.n").alias("n")), "blocks")
    moves = F.explode(F.array(*[F.array(*map(F.lit, m)) for m in _moves(groups)]))
    to = cells.select(F.col("cell").alias("cell_b"), F.col("blocks").alias("blocks_b"))
    pairs = cells.withColumn("move", moves).withColumn("cell_b", F.zip_with("cell", "move", lambda x, y: x + y)).join(to, "cell_b")
    pairs = pairs.select("cell", "cell_b", "blocks_b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    pairs = pairs.select("cell", "cell_b", "block", F.explode(F.sequence(F.lit(0), F.col("blocks_b") - 1)).alias("block_b"))
    pairs = pairs.where((F.col("cell") != F.col("cell_b")) | (F.col("block") <= F.col("block_b")))
    a = packed.select("cell", "block", F.col("length").alias("la"), F.col("blob").alias("blob_a"), F.col("n").alias("n_a"))
    b = packed.select(F.col("cell").alias("cell_b"), F.col("block").alias("block_b"), F.col("length").alias("lb"),
                      F.col("blob").alias("blob_b"), F.col("n").alias("n_b"))
    same = (F.col("cell") == F.col("cell_b")) & (F.col("block") == F.col("block_b"))
    # the work is in the pairs, not in their bytes: so many tasks, whatever the sizes
    both = pairs.join(a, ["cell", "block"]).repartition(4 * parts, "cell_b", "block_b").join(b, ["cell_b", "block_b"])
    got = both.select("la", "blob_a", "n_a", same.alias("same"), "lb", "blob_b", "n_b").mapInArrow(_near, PARTIAL)
    return got.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("n"), "best")).alias("x")).select(
        "word", "n_near", (-F.col("x.n")).alias("best_n"), F.col("x.best").alias("best"))


def roots(forms: DataFrame, scratch: Scratch, longest: int) -> DataFrame:
    """(word, root) of words that have a form, in chains of at most ``longest`` steps: pointers are doubled."""
    at = scratch.keep(forms.select("word", F.col("form").alias("root")), "forms")
    for _ in range(math.ceil(math.log2(max(1, longest)))):
        step = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        at = scratch.keep(at.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
    return at


def variants(docs: DataFrame, scratch: Scratch, doc_id: str = "doc_id", text: str = "text", shortest: int = SHORTEST,
             least: int = LEAST, times: int = TIMES, every: int = DROP_EVERY, groups: int | None = None) -> DataFrame:
    """word, form, root, n, n_near, form_n of all words of a table's texts.

    A word is a maximal run of ``A-Za-z`` and U+00C0 to U+00FF, A-Z in lower
    case, of ``shortest`` letters and ``least`` occurrences or more; where the
    hash of the document's id (null: empty) and the run says so, it lacks one
    letter (see ``variant``). A word's form is its near word (one letter
    inserted, deleted or replaced) of largest n, of equals the first in
    code-point order, if that has ``times`` the word's own n or more, else null;
    its root is where its forms lead. Null and empty texts have no words,
    repeated rows count each time, an empty table gives no row, other columns
    are not read. The result reads tables of ``scratch``."""
    if times < 2:
        raise ValueError("forms must have more occurrences than the word, or chains could be circles")
    words = scratch.keep(count_words(docs, doc_id, text, shortest, least, every), "words")
    most = words.agg(F.max("n")).first()[0] or 0
    near = scratch.keep(near_words(words, scratch, groups), "near")
    ok = F.col("best_n") >= times * F.col("n")
    w = scratch.keep(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(ok, F.col("best")).alias("form"),
        F.when(ok, F.col("best_n")).alias("form_n")), "formed")
    longest = 1 + int(math.log(max(1, most / least), times))        # n grows by ``times`` with each step
    up = roots(w.where("form is not null"), scratch, longest)
    return w.join(up, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def q_op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants of all words of ``documents``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    with Scratch(spark, "op11") as s:
        return s.keep(variants(docs, s), result=True)
