"""N-gram Jaccard join by parity sketches.

Two sets link if |A and B| * den >= |A or B| * num. Then their symmetric
difference is at most (1 - J) / (1 + J) * (|A| + |B|), and with respect to the
smaller set at most D(n) = n * (1 - J) / J tokens.

*Sketches.* Tokens are dealt to the parts of a sketch and XORed there: a token
changes its part, tokens in both sets cancel out, so the number of parts that
differ is at most the symmetric difference. Sets of one size band (sizes
between two powers of two) use one layout; a set that may link with larger
ones of the next band is also sketched in that band's layout.

*Pigeonhole join.* Of a set's first D + 1 usable parts at least one is equal
in any set it links with, so sets are joined on (band, part, value). A part
is usable if it holds enough tokens to tell sets apart; parts that many sets
share (hot ones) say little, and sets emit some parts more than they need so
that they can do without those. Sets that still fall short are compared in
the hot groups too, which keeps the join exact.

*Verification.* Candidates are checked by sizes, by the Hamming distance of a
bit-parity sketch (again a lower bound of the symmetric difference), and then
exactly on their shingles.

*No group is expanded.* Equal sets are one class from the start. The members
of a group are first linked in a chain, those of a hot group also with the
member that is in most hot groups; what is in one component after that needs
no further comparison. What is still apart in a hot group is compared inside
the tasks, in blocks of rows: first by bit sketches, which tell only which
components may be linked at all (a pair for each two of them that no other pair
has joined, so never more than there are rows); then, where those components
meet, by their shingles, which gives such pairs of those that do link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.common import Scratch, lean, release, shuffle_partitions, table
from marquee.llm.components import components
from marquee.llm.sarray import numbered
from marquee.llm.shingles import exact_shingles, mix, shingles

#: Groups of more members are hot.
HOT = 8
#: Rows of a hot group's side that one task compares at a time.
BLOCK = 2048
#: The same where the rows bring their texts.
TEXT_BLOCK = 1024


def difference(n: int, num: int, den: int) -> int:
    """The largest symmetric difference of a set of ``n`` and one at least as large that links with it."""
    return n * (den - num) // num


def layout(band: int, num: int, den: int) -> int:
    """Parts of a band's sketch: half as many again as its largest sets need."""
    return difference((2 << band) - 1, num, den) * 3 // 2 + 4


def bit_sketch(h: np.ndarray) -> bytes:
    """Parity of tokens by bit; twice as many bits as the band's largest size."""
    bits = max(64, 2 << int(len(h)).bit_length())
    odd = np.bincount((h & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def hamming(a: bytes, b: bytes) -> int:
    """Distance of two bit sketches; the longer is folded, which keeps parity."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    return int(np.bitwise_count(_fold(x, len(y)) ^ _fold(y, len(x))).sum())


def part_keys(h: np.ndarray, num: int, den: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(band, slack, keys) of a set's sorted token hashes: the emitted parts'
    keys in each layout, and how many of them it can do without."""
    n = len(h)
    d = difference(n, num, den)
    if d < 1:
        return                      # such a set links with equal sets only
    own = n.bit_length() - 1
    value = mix(h ^ np.uint64(0x5851F42D4C957F2D))
    for band in ((own, own + 1) if n * den // num >= 2 << own else (own,)):
        parts = layout(band, num, den)
        part = ((h >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)       # grows with h, so parts are runs
        first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        x = np.bitwise_xor.reduceat(value, first)
        at, size = part[first], np.diff(np.append(first, n))
        usable = np.flatnonzero(size >= (1 if band < 6 else 2))
        if len(usable) > d:
            usable = usable[:d + 1 + max(2, d // 5)]
            slack = len(usable) - d - 1
            at, x = at[usable], x[usable]
        else:                       # too few: all parts, the empty ones too
            slack = -1
            full = np.zeros(parts, np.uint64)
            full[at.astype(np.int64)] = x
            at, x = np.arange(parts, dtype=np.uint64), full
        yield band, slack, mix(x + mix(at * np.uint64(64) + np.uint64(band + 1))).view(np.int64)


@lean
def _sets(it: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for b in it:
        out = []
        for t in b.column(1):
            h = shingles(t.as_py(), k)
            s = xxhash.xxh3_128_intdigest(h.tobytes())
            out.append((len(h), s >> 64, s & 0xFFFFFFFFFFFFFFFF, bit_sketch(h)))
        n, s1, s2, sketch = zip(*out) if out else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(n, pa.int64()), pa.array(np.array(s1, np.uint64).view(np.int64)),
             pa.array(np.array(s2, np.uint64).view(np.int64)), pa.array(sketch, pa.binary())],
            names=["row", "n", "s1", "s2", "sketch"])


KEY = "key long, row long, band int, slack int"


@lean
def _keys(it: Iterator[pa.RecordBatch], k: int, num: int, den: int) -> Iterator[pa.RecordBatch]:
    for b in it:
        for at in range(0, b.num_rows, 500):
            key, row, band, slack = [], [], [], []
            for r, t in zip(b.column(0)[at:at + 500].to_pylist(), b.column(1)[at:at + 500].to_pylist()):
                for g, s, x in part_keys(shingles(t, k), num, den):
                    key.append(x)
                    row.append(np.full(len(x), r, np.int64))
                    band.append(np.full(len(x), g, np.int32))
                    slack.append(np.full(len(x), s, np.int32))
            if key:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (key, row, band, slack)],
                                                 names=["key", "row", "band", "slack"])


GROUP = "kind string, key long, band int, slack int, members array<bigint>"


@lean
def _groups(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows in order of key and row: groups of up to HOT members whole;
    of larger ones each member, and each pair of neighbours. Holds one batch
    and at most HOT rows of the group that crosses its end."""
    schema = pa.schema([("kind", pa.string()), ("key", pa.int64()), ("band", pa.int32()), ("slack", pa.int32()),
                        ("members", pa.list_(pa.int64()))])
    last_key, open_rows, is_hot = None, [], False
    out: list[tuple] = []

    def hot_rows(rows, before):
        for r in rows:
            out.append(("member", last_key, r[1], r[2], [r[0]]))
            if before is not None:
                out.append(("pair", None, None, None, [before, r[0]]))
            before = r[0]

    def close():
        if not is_hot and len(open_rows) > 1:
            out.append(("group", None, None, None, [r[0] for r in open_rows]))

    for b in it:
        keys = b.column(0).to_numpy()
        if not len(keys):
            continue
        edge = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        ends = np.append(edge[1:], len(keys))
        # only runs of two or more, and the runs at the batch's ends, can matter
        use = np.unique(np.concatenate((np.flatnonzero(ends - edge > 1), [0, len(edge) - 1])))
        row, band, slack = (b.column(c).to_numpy() for c in (1, 2, 3))
        for i in use.tolist():
            s, e = int(edge[i]), int(ends[i])
            key = int(keys[s])
            rows = list(zip(row[s:e].tolist(), band[s:e].tolist(), slack[s:e].tolist()))
            if key != last_key:
                close()
                last_key, open_rows, is_hot = key, [], False
            if not is_hot and len(open_rows) + len(rows) > HOT:
                is_hot = True
                hot_rows(open_rows + rows, None)
                open_rows = rows[-1:]
            elif is_hot:
                hot_rows(rows, open_rows[-1][0])
                open_rows = rows[-1:]
            else:
                open_rows += rows
        if len(out) > 20_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
            out = []
    close()
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def _near(num: int, den: int):
    """(x, y, n_x, n_y, sketch_x, sketch_y) -> may the sets link, by the sketches."""
    @F.pandas_udf("boolean")
    def near(nx: pd.Series, ny: pd.Series, sx: pd.Series, sy: pd.Series) -> pd.Series:
        return pd.Series([hamming(a, b) * (den + num) <= (den - num) * (m + n)
                          for m, n, a, b in zip(nx, ny, sx, sy)], dtype=bool)

    return near


def _linked(k: int, num: int, den: int):
    @lean
    def check(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple = (None, set())
        for b in it:
            keep = []
            for x, tx, ty in zip(b.column(0).to_pylist(), b.column(2), b.column(3)):
                if last[0] != x:
                    last = (x, exact_shingles(tx.as_py(), k))
                other = exact_shingles(ty.as_py(), k)
                both = len(last[1] & other)
                keep.append(both * den >= (len(last[1]) + len(other) - both) * num)
            m = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(m), b.column(1).filter(m)], names=["u", "v"])

    return check


class _Join:
    def __init__(self, stored: DataFrame, row: str, text: str, sets: DataFrame, k: int, num: int, den: int, scratch: Scratch):
        self.text = stored.select(F.col(row).alias("row"), F.col(text).alias("t"))
        self.sets, self.k, self.num, self.den, self.scratch = sets, k, num, den, scratch

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (u, v) that link."""
        s = self.sets.select("row", "n", "sketch")
        p = pairs.join(s.toDF("u", "nu", "su"), "u").join(s.toDF("v", "nv", "sv"), "v")
        p = p.where((F.least("nu", "nv") * self.den >= F.greatest("nu", "nv") * self.num))
        p = self.scratch.keep(p.where(_near(self.num, self.den)("nu", "nv", "su", "sv")).select("u", "v"), "near")
        t = self.text
        one = t.join(p.hint("shuffle_hash"), t["row"] == p["u"]).select("u", "v", F.col("t").alias("tu"))
        both = t.join(one.hint("shuffle_hash"), t["row"] == one["v"]).select("u", "v", "tu", F.col("t").alias("tv"))
        return self.scratch.keep(both.mapInArrow(_linked(self.k, self.num, self.den), "u long, v long"), "links")


def _cross(members):
    """Pairs of members (row, component) of one group in different components."""
    return F.flatten(F.transform(members, lambda a: F.transform(
        F.filter(members, lambda b: (b["row"] > a["row"]) & (b["component"] != a["component"])),
        lambda b: F.struct(a["row"].alias("u"), b["row"].alias("v")))))


def _joining(comp: np.ndarray, x: np.ndarray, near, linked=None) -> Iterator[tuple[int, int]]:
    """Pairs of positions that join components: of the rows ``x`` and those that
    ``near`` names for them, a pair for each two components that no pair before
    has joined. With ``linked`` only pairs that it confirms join."""
    label = np.unique(comp, return_inverse=True)[1]
    for i in x.tolist():
        others = near(i)
        while len(others := others[label[others] != label[i]]):
            j = int(others[0])
            if linked is None or linked(i, j):
                yield i, j
                label[label == label[j]] = label[i]
            else:
                others = others[1:]


def _near_rows(pdf: pd.DataFrame, num: int, den: int):
    """(rows of the short side, function that gives the other side's rows whose sketches do not rule out a link)."""
    # sketches of a band or its neighbour; folded to the shortest
    raw = [np.frombuffer(b, np.uint8) for b in pdf["sketch"]]
    size = min(map(len, raw))
    flat, n = np.stack([_fold(b, size) for b in raw]), pdf["n"].to_numpy()
    x, y = np.flatnonzero(pdf["side"] == 0), np.flatnonzero(pdf["side"] == 1)
    flat_y, n_y = flat[y], n[y]

    def near(i: int) -> np.ndarray:
        d = np.bitwise_count(flat_y ^ flat[i]).sum(axis=1, dtype=np.int64)
        return y[(d * (den + num) <= (den - num) * (n_y + n[i])) & (np.minimum(n_y, n[i]) * den >= np.maximum(n_y, n[i]) * num)]

    return x, near


def _compare(num: int, den: int):
    """Components that one block of short rows and one of any rows may link by their sketches."""
    def compare(key, pdf: pd.DataFrame) -> pd.DataFrame:
        comp = pdf["component"].to_numpy()
        x, near = _near_rows(pdf, num, den)
        pairs = [(comp[i], comp[j]) for i, j in _joining(comp, x, near)] if len(x) else []
        return pd.DataFrame(pairs, columns=["u", "v"], dtype="int64")

    return compare


def _linking(k: int, num: int, den: int):
    """Pairs of linked rows that join the components of one block of short rows and one of any rows."""
    def compare(key, pdf: pd.DataFrame) -> pd.DataFrame:
        row, comp, text = pdf["row"].to_numpy(), pdf["component"].to_numpy(), pdf["t"]
        hashes: dict[int, np.ndarray] = {}
        last: tuple = (None, set())

        def hashed(i: int) -> np.ndarray:
            if i not in hashes:
                hashes[i] = shingles(text.iat[i], k)
            return hashes[i]

        def linked(i: int, j: int) -> bool:
            nonlocal last
            a, b = hashed(i), hashed(j)
            both = len(np.intersect1d(a, b, assume_unique=True))
            if both * den < (len(a) + len(b) - both) * num:
                return False
            if last[0] != i:
                last = (i, exact_shingles(text.iat[i], k))
            other = exact_shingles(text.iat[j], k)
            both = len(last[1] & other)
            return both * den >= (len(last[1]) + len(other) - both) * num

        x, near = _near_rows(pdf, num, den)
        pairs = [(min(row[i], row[j]), max(row[i], row[j])) for i, j in _joining(comp, x, near, linked)] if len(x) else []
        release()
        return pd.DataFrame(pairs, columns=["u", "v"], dtype="int64")

    return compare


def _fold(x: np.ndarray, size: int) -> np.ndarray:
    while len(x) > size:
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    return x


def _meet(r: DataFrame, key: str, block: int, cols: list[str]) -> DataFrame:
    """The rows of a group, block by block, each block pair a group (key, i, j) of its
    own: short rows (of which it has ``x``, as side 0) meet all (``y``, as side 1)."""
    blocks = lambda c: F.ceil(F.col(c) / F.lit(block)).cast("int")
    own = lambda c: F.pmod(F.xxhash64("row"), blocks(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), blocks(c) - 1))
    cols = [key, "i", "j", "side", "row", "component", "n", "sketch", *cols]
    x = r.where("short").withColumn("i", own("x")).withColumn("j", every("y")).withColumn("side", F.lit(0)).select(cols)
    y = r.withColumn("j", own("y")).withColumn("i", every("x")).withColumn("side", F.lit(1)).select(cols)
    return x.unionByName(y).groupBy(key, "i", "j")


def _mixed(named: DataFrame, key: str) -> DataFrame:
    """Groups with more than one component and a short row: their short rows (x) and all (y)."""
    return named.groupBy(key).agg(F.min("component").alias("a"), F.max("component").alias("b"), F.count_if("short").alias("x"),
                                  F.count(F.lit(1)).alias("y")).where("a <> b and x > 0").select(key, "x", "y")


def _apart(named: DataFrame, sets: DataFrame, texts: DataFrame, k: int, num: int, den: int, scratch: Scratch) -> DataFrame:
    """(u, v) that join components of hot groups, of rows that link and one of which is short.

    By sketches the rows of each hot group tell which components may be linked;
    components that hang together in this way form a cluster, and all pairs that
    may link are in one. The rows of a cluster then meet once with their texts,
    however many hot groups they share."""
    sketched = sets.select("row", "n", "sketch")
    rows = named.join(_mixed(named, "key"), "key").join(sketched, "row")
    may = scratch.keep(_meet(rows, "key", BLOCK, []).applyInPandas(_compare(num, den), "u long, v long").distinct(), "may")
    cluster = scratch.keep(components(may, scratch).toDF("component", "cluster"), "clusters")
    once = named.groupBy("row", "component").agg(F.max("short").alias("short")).join(cluster, "component")
    once = scratch.keep(once, "once")
    rows = once.join(_mixed(once, "cluster"), "cluster").join(sketched, "row")
    rows = scratch.keep(texts.join(rows.hint("shuffle_hash"), "row"), "rows")
    return _meet(rows, "cluster", TEXT_BLOCK, ["t"]).applyInPandas(_linking(k, num, den), "u long, v long")


def near_duplicates(docs: DataFrame, scratch: Scratch, doc_id: str = "doc_id", text: str = "text", k: int = 5,
                    num: int = 80, den: int = 100) -> tuple[DataFrame, DataFrame, str]:
    """(stored, result, row): ``docs`` stored with a row number, and for each
    row (row, n_shingles, component_id, first): the size of its set, the least
    id in its component (nulls last) and whether it is the row with that id
    that comes first.

    A document's set is its distinct ``k``-word shingles (fewer words: one
    shingle), and two link at a Jaccard similarity of ``num / den`` or more
    (at least 1/2). Null, empty and blank texts have no shingles and link with
    nothing. Repeated rows and equal sets are one class. Links are exact.
    """
    spark = docs.sparkSession
    stored, row = numbered(docs, scratch)
    texts = stored.select(F.col(row).alias("row"), F.col(text).alias("t"))
    sets = texts.mapInArrow(lambda it: _sets(it, k), "row long, n long, s1 long, s2 long, sketch binary")
    sets = scratch.bucketed(sets.repartition(shuffle_partitions(spark), "row"), "row")
    ids = stored.select(F.col(row).alias("row"), F.col(doc_id).alias("id"))
    classes = scratch.keep(sets.where("n > 0").join(ids, "row").groupBy("s1", "s2").agg(
        F.min("row").alias("rep"), F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("least")), "classes")

    # candidates: one set of each class, joined on its sketch's parts
    reps = texts.join(classes.select(F.col("rep").alias("row")).hint("shuffle_hash"), "row", "left_semi")
    keys = reps.select("row", "t").mapInArrow(lambda it: _keys(it, k, num, den), KEY)
    keys = keys.repartition(shuffle_partitions(spark), "key").sortWithinPartitions("key", "row")
    found = scratch.keep(keys.mapInArrow(_groups, GROUP), "groups")
    groups = scratch.keep(found.where("kind = 'group'").select("members").distinct(), "groups")
    chain = groups.select(F.explode(F.expr(
        "transform(sequence(1, size(members) - 1), i -> struct(members[i - 1] as u, members[i] as v))")).alias("p"))
    hot = found.where("kind = 'pair'").select(F.struct(F.col("members")[0].alias("u"), F.col("members")[1].alias("v")).alias("p"))
    members = found.where("kind = 'member'").select("key", "band", "slack", F.col("members")[0].alias("row"))
    degree = members.groupBy("row").agg(F.count(F.lit(1)).alias("d"), (-F.col("row")).alias("r"))
    hub = members.join(degree, "row").groupBy("key").agg((-F.max(F.struct("d", "r"))["r"]).alias("hub"))
    spokes = members.join(hub, "key").where("row <> hub").select(
        F.struct(F.least("row", "hub").alias("u"), F.greatest("row", "hub").alias("v")).alias("p"))
    first = scratch.keep(chain.unionByName(hot).unionByName(spokes).select("p.u", "p.v").distinct(), "pairs")
    join = _Join(stored, row, text, sets, k, num, den, scratch)
    links = join.links(first)
    label = scratch.keep(components(links, scratch), "labels")

    # what the chains left apart
    of = lambda df: df.join(label.withColumnRenamed("node", "row"), "row", "left").withColumn(
        "component", F.coalesce("component", "row"))
    big = groups.where("size(members) > 2").withColumn("g", F.xxhash64("members"))
    open_groups = of(big.select("g", F.explode("members").alias("row"))).groupBy("g").agg(
        F.collect_list(F.struct("row", "component")).alias("m"))
    rest = open_groups.select(F.explode(_cross(F.col("m"))).alias("p")).select("p.u", "p.v")
    short = members.groupBy("row", "band").agg(F.count(F.lit(1)).alias("m"), F.first("slack").alias("s")).where("m > s")
    named = scratch.keep(of(members.select("key", "band", "row")).join(
        short.select("row", "band", F.lit(True).alias("short")), ["row", "band"], "left")
        .withColumn("short", F.coalesce("short", F.lit(False))), "hot")
    rest = rest.unionByName(_apart(named, sets, texts, k, num, den, scratch))
    rest = scratch.keep(rest.distinct().join(first, ["u", "v"], "left_anti"), "pairs")
    more = join.links(rest)
    label = scratch.keep(components(links.unionByName(more), scratch), "labels")

    # classes by component, rows by class
    c = classes.join(label.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    least = c.groupBy("component").agg(F.min("least").alias("top"))
    c = scratch.keep(c.select("s1", "s2", "component").join(least, "component").select("s1", "s2", "top"), "classes")
    result = sets.drop("sketch").join(ids, "row").join(c, ["s1", "s2"], "left").select(
        "row", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("top.id")).otherwise(F.col("id")).alias("component_id"),
        F.coalesce((F.col("n") == 0) | (F.col("row") == F.col("top.row")), F.lit(True)).alias("first"))
    return stored, result, row


def q_op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share 85 % of their 4-word shingles."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    with Scratch(spark, "op10") as s:
        stored, result, row = near_duplicates(docs, s, k=4, num=85, den=100)
        ids = stored.select(F.col(row).alias("row"), "doc_id")
        return s.keep(ids.join(result, "row").select("doc_id", "n_shingles", "component_id"), result=True)
