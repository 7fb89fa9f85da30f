"""Benchmark decontamination: a prefix-filtered containment join.

Each benchmark item gives windows of ``window`` consecutive words (an item of
fewer words is one window). A document contains a window exactly if all of the
window's words stand there in order, so at containment 1 the necessary prefix
of a window in rarity order is its rarest word (prefix length = words - needed
+ 1). Rarity is counted over all documents. The join works on that word: each
occurrence proposes one start (positional bound), which must leave room for
the whole window (length bound), and the words there are compared exactly.

The benchmark side reaches the tasks in blocks of at most ``block_bytes``;
a larger benchmark is scanned block by block, with the hits so far carried
along, so what is broadcast never grows with the data.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.common import ASCII_LOWER, Scratch, fresh, table

# fixed values: word bytes are digits, letters (lower-cased) and everything outside ASCII
_WORD = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
TABLE = bytes(_WORD[ASCII_LOWER[b]] for b in range(256))

FOUND = ("struct<n_words:bigint,n_hit:bigint,items:array<string>,"
         "spans:array<struct<first:bigint,last:bigint>>>")


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(TABLE).split() if text else []


def _windows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, texts = [], []
        for item, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            w = words(text)
            got = {b" ".join(w[i:i + window]) for i in range(max(1, len(w) - window + 1))} if w else ()
            ids += [item or ""] * len(got)
            texts += got
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(texts, pa.binary())],
                                         names=["item", "win"])


def benchmark_windows(benchmark: DataFrame, window: int, item: str = "item_id", text: str = "text") -> DataFrame:
    """(item, win): the distinct windows of each item."""
    b = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text"))
    return b.mapInArrow(lambda it: _windows(it, window), "item string, win binary").distinct()


def word_counts(docs: DataFrame, text: str, vocabulary) -> dict[bytes, int]:
    """How often each word of the broadcast ``vocabulary`` occurs in all documents."""
    def count(batches):
        c: Counter = Counter()
        for b in batches:
            for t in b.column(0).to_pylist():
                c.update(filter(vocabulary.value.__contains__, words(t)))
        yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.binary()), pa.array(list(c.values()), pa.int64())],
                                         names=["word", "n"])

    got = docs.select(F.col(text).alias("t")).mapInArrow(count, "word binary, n long").groupBy("word").agg(
        F.sum("n").alias("n"))
    return {bytes(r["word"]): r["n"] for r in got.toLocalIterator()}       # at most the block's words


def prefix_index(pairs: list[tuple[str, bytes]], counts: dict[bytes, int]) -> dict:
    """rarest word -> [(its position in the window, window, items)]."""
    items: dict[bytes, list[str]] = defaultdict(list)
    for item, win in pairs:
        items[win].append(item)
    index: dict[bytes, list] = defaultdict(list)
    for win, ids in items.items():
        w = win.split()
        _, rare, p = min((counts.get(x, 0), x, i) for i, x in enumerate(w))
        index[rare].append((p, w, tuple(sorted(ids))))
    return dict(index)


def hits(w: list[bytes], index: dict, spans: list, items: set) -> tuple[list[tuple[int, int]], set]:
    """Occurrences of the index's windows in the words ``w``, as merged [first, last] runs."""
    n, found = len(w), list(spans)
    for i, entries in [(i, index[x]) for i, x in enumerate(w) if x in index]:
        for p, win, ids in entries:
            s, e = i - p, i - p + len(win)
            if s >= 0 and e <= n and w[s:e] == win:
                found.append((s, e - 1))
                items.update(ids)
    found.sort()
    out: list[tuple[int, int]] = []
    for s, e in found:
        if out and s <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out, items


def contamination(docs: DataFrame, benchmark: DataFrame, out: str, scratch: Scratch, text: str = "text",
                  item: str = "item_id", item_text: str = "text", window: int = 10,
                  block_bytes: int = 32 << 20) -> DataFrame:
    """``docs`` with a struct column ``out``: n_words, n_hit (words inside any
    occurrence of a window), items (ids of items with occurring windows, as
    sorted strings) and spans (runs of hit words, numbered from 0).

    Words are runs of digits, ASCII letters (case ignored) and non-ASCII
    characters. Null or empty texts and items have none and match nothing; an
    item without an id counts as ''. Repeated rows are kept and judged alike,
    items of one id count once. All other columns stay as they are; ``out``
    must not be one of them.
    """
    spark = docs.sparkSession
    pairs = scratch.keep(benchmark_windows(benchmark, window, item, item_text), "windows")
    size = pairs.agg(F.sum(F.length("win") + F.octet_length("item") + 64)).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    names, df = docs.columns, docs
    state = fresh(docs, "hits_so_far")
    for k in range(blocks):
        part = pairs.where(F.pmod(F.xxhash64("item", "win"), F.lit(blocks)) == k)
        block = [(r["item"], bytes(r["win"])) for r in part.toLocalIterator()]
        vocabulary = spark.sparkContext.broadcast(frozenset(x for _, win in block for x in win.split()))
        index = spark.sparkContext.broadcast(prefix_index(block, word_counts(docs, text, vocabulary) if block else {}))
        before = [F.col(state)] if k else []
        df = df.select(*names, _search(index)(F.col(text), *before).alias(state))
        if k < blocks - 1:
            df = scratch.keep(df, "hits")
    return df.withColumnRenamed(state, out)


def _search(index):
    def find(texts: pd.Series, before: pd.DataFrame | None) -> pd.DataFrame:
        rows = []
        for i, t in enumerate(texts):
            w = words(t)
            spans, items = [], set()
            if before is not None:
                spans = [(int(x["first"]), int(x["last"])) for x in before["spans"].iloc[i]]
                items = set(before["items"].iloc[i])
            spans, items = hits(w, index.value, spans, items)
            rows.append((len(w), sum(e - s + 1 for s, e in spans), sorted(items),
                         [{"first": s, "last": e} for s, e in spans]))
        return pd.DataFrame(rows, columns=["n_words", "n_hit", "items", "spans"])

    @F.pandas_udf(FOUND)
    def first(texts: pd.Series) -> pd.DataFrame:
        return find(texts, None)

    @F.pandas_udf(FOUND)
    def more(texts: pd.Series, before: pd.DataFrame) -> pd.DataFrame:
        return find(texts, before)

    return lambda *cols: (more if len(cols) == 2 else first)(*cols)


def q_op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    docs, bench = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    with Scratch(spark, "op2") as s:
        got = contamination(docs.select("doc_id", "text"), bench, "found", s)
        f = F.col("found")
        return s.keep(got.select(
            "doc_id", f["n_words"].alias("n_words"), f["n_hit"].alias("n_hit"),
            F.size(f["items"]).cast("long").alias("n_items"),
            F.sha2(F.array_join(f["items"], ",").cast("binary"), 256).alias("items_sha256"),
            (f["n_hit"] > 0).alias("contaminated")), result=True)
