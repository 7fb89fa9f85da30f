"""Top n by dot product, with the items in order of their norm.

Items are range-partitioned by falling norm into blocks. A product is at most
the product of the norms, so once a user's n-th best score is above |user| times
the largest norm of a block, that block and all after it hold nothing for the
user. Blocks are taken in rounds of growing size: after each round the users
keep their n best so far, and only users who can still gain go on. Blocks that
follow each other form runs of bounded size; a user is sent to a run once, and
the task takes its blocks in order and raises the bars as it goes, so that it
hands on at most n rows a user. All rounds together read the item blocks once
for each block of open users; the number of rounds grows with the logarithm of
the number of blocks. Where the norms close nothing (most users could still gain
from the last block) the blocks that are left are one round.

Scores that decide are computed pair by pair, always in the same way (matrix
products only choose them), so that they do not depend on the blocks. The products
that choose are of vectors scaled to length one at most, in single precision, with
a bound of its rounding left open; a run and a block of users are one task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.expr import norm
from marquee.operators.blocks import CHUNK_BYTES, DEFAULT_BLOCK_BYTES, dealt_to_tasks, groups_of
from marquee.operators.topk import top_n_per_group
from marquee.session import scratch_root, ship_package

ITEM_ROWS = 8192        # items of a block, while that gives at most MAX_BLOCKS
MAX_BLOCKS = 4096
GROWTH = 4              # a round takes so many times the blocks that all rounds before it took
USER_ROWS = 1 << 17     # users of a block; fewer while there are not MIN_PARTS blocks
MIN_PARTS = 16
TILE = 512              # items of a tile, TILE_BYTES of products: what stays in a core's cache
TILE_BYTES = 2 << 20
DENSE = 4               # hits of a tile, in rows of n, from which a tile's own n-th best is looked for
_SLACK = 1e-9


def _vectors(df: DataFrame, key: str, kind: str) -> DataFrame:
    """(key, v, norm) of finite vectors."""
    v = df.select(key, F.col("features").cast(kind).alias("v")).where(F.col("v").isNotNull())
    return v.withColumn("norm", norm("v")).where(F.col("norm") < float("inf"))


def _norms(m: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", m, m, dtype=np.float64))


def _scaled(m: np.ndarray, norms: np.ndarray | float) -> np.ndarray:
    return (m / np.where(norms > 0, norms, 1.0)).astype(np.float32)


def _scores(users: np.ndarray, items: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """The products that decide, pair by pair in double precision."""
    return np.concatenate([np.zeros(0), *((users[rows[i:i + 65536]].astype(np.float64) * items[cols[i:i + 65536]].astype(np.float64)).sum(axis=1)
                                          for i in range(0, len(rows), 65536))])


def best_rows(users: np.ndarray, bars: np.ndarray, items: np.ndarray, ids: np.ndarray, n: int,
              least: float | None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(user rows, item rows, scores): each user's ``n`` best items (score desc,
    id asc) whose score reaches the user's bar and is above ``least``."""
    norms, norm = _norms(users), _norms(items).max()
    u32, v32 = _scaled(users, norms[:, None]), _scaled(items, norm)
    # products of vectors of length one at most are off by less than this (rounding of both and of the sum)
    slack = np.float32((users.shape[1] + 8) * 2.0 ** -23)
    with np.errstate(over="ignore"):
        floors = bars / np.where(norms > 0, norms, 1.0) / (norm if norm > 0 else 1.0) - slack
        floors = np.nextafter(np.clip(floors, -4.0, 4.0).astype(np.float32), np.float32(-8.0))
    tile = min(len(items), TILE)
    step = max(1, min(CHUNK_BYTES // (8 * len(items)), TILE_BYTES // (4 * tile)))
    products, high = np.empty(step * tile, np.float32), np.empty(step, np.float32)
    for lo in range(0, len(users), step):
        u, floor = u32[lo:lo + step], floors[lo:lo + step]
        rows, cols, most = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], DENSE * n * len(u)
        for at in range(0, len(items), tile):
            v = v32[at:at + tile]
            s = np.matmul(u, v.T, out=products[:len(u) * len(v)].reshape(len(u), len(v)))
            on = np.flatnonzero(np.max(s, axis=1, out=high[:len(u)]) >= floor)
            i, j = np.nonzero(s[on] >= floor[on, None])
            rows.append(on[i])
            cols.append(j + at)
            most -= len(i)
            if most < 0:
                break
        if most < 0:                    # the bars close little: the n-th best of this block is a better one
            s = u @ v32.T
            if len(items) > n:
                floor = np.maximum(floor, np.partition(s, len(items) - n, axis=1)[:, len(items) - n] - 2 * slack)
            r, c = np.nonzero(s >= floor[:, None])
        else:
            r, c = np.concatenate(rows), np.concatenate(cols)
        score = _scores(users[lo:lo + step], items, r, c)
        order = np.lexsort((ids[c], -score, r))
        r, c, score = r[order], c[order], score[order]
        keep = np.arange(len(r)) - np.searchsorted(r, r) < n
        if least is not None:
            keep &= score > least
        yield r[keep] + lo, c[keep], score[keep]


def best_of_run(users: np.ndarray, bars: np.ndarray, items: np.ndarray, ids: np.ndarray, block: np.ndarray, n: int,
                least: float | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(user rows, ids, scores): each user's ``n`` best items over blocks of falling norm."""
    norms = _norms(users)
    bars = bars.copy()
    rows, mids, scores = np.zeros(0, np.int64), np.zeros(0, ids.dtype), np.zeros(0)
    for b in np.unique(block).tolist():
        at = np.flatnonzero(block == b)
        v, k = items[at], ids[at]
        on = np.flatnonzero(norms * _norms(v).max() * (1 + _SLACK) >= bars)
        if not len(on):
            break                       # later blocks have smaller norms
        got = [(on[r], k[c], x) for r, c, x in best_rows(users[on], bars[on], v, k, n, least) if len(r)]
        if not got:
            continue
        new = [np.concatenate(x) for x in zip(*got)]
        touched = np.zeros(len(users), bool)
        touched[new[0]] = True
        old = touched[rows]
        r, m, x = (np.concatenate((a[old], c)) for a, c in zip((rows, mids, scores), new))
        order = np.lexsort((m, -x, r))
        r, m, x = r[order], m[order], x[order]
        place = np.arange(len(r)) - np.searchsorted(r, r)
        last = place == n - 1
        bars[r[last]] = np.maximum(bars[r[last]], x[last])
        keep = place < n
        rows, mids, scores = (np.concatenate((a[~old], c[keep])) for a, c in zip((rows, mids, scores), (r, m, x)))
    return rows, mids, scores


def runs_of(blocks: list[tuple], rows: int) -> list[list[tuple]]:
    """Blocks (block, top, n) that follow each other, ``rows`` items in a run if no block has more."""
    runs: list[list[tuple]] = []
    for b in blocks:
        if not runs or sum(x[2] for x in runs[-1]) + b[2] > rows:
            runs.append([])
        runs[-1].append(b)
    return runs


def top_by_dot(
    user_f: DataFrame,
    item_f: DataFrame,
    n: int = 10,
    min_score: float | None = 0.0,
    item_rows: int | None = None,
    user_rows: int | None = None,
    work: dict | None = None,
) -> DataFrame:
    """uid, rank, mid, score: per user (uid, features) the ``n`` items (mid,
    features) of highest dot product above ``min_score`` (ties: lower mid).
    Users and items without a finite vector drop out. A ``work`` given gets
    the numbers of user-item pairs: ``all``, and those ``scored``."""
    spark = user_f.sparkSession
    ship_package(spark)
    scratch_root(spark)                         # names the checkpoint folder
    # vectors go along as they are given: float32 factors are half as wide, and the products are of doubles in any case
    kinds = {df.schema["features"].dataType.simpleString() for df in (item_f, user_f)}
    kind, wide = ("array<float>", 4) if kinds == {"array<float>"} else ("array<double>", 8)
    items, users = _vectors(item_f, "mid", kind), _vectors(user_f, "uid", kind)
    n_items, top, width = items.agg(F.count(F.lit(1)), F.max("norm"), F.max(F.size("v"))).first()
    n_users = users.count()
    n_blocks = max(1, math.ceil(n_items / (item_rows or max(ITEM_ROWS, math.ceil(n_items / MAX_BLOCKS)))))
    if n_blocks == 1:
        items, blocks = items.withColumn("block", F.lit(0)), [(0, top, n_items)] if n_items else []
    else:
        items = items.repartitionByRange(n_blocks, F.desc("norm"), F.asc("mid")).withColumn("block", F.spark_partition_id()).checkpoint()
        blocks = sorted((r["block"], r["top"], r["n"]) for r in
                        items.groupBy("block").agg(F.max("norm").alias("top"), F.count(F.lit(1)).alias("n")).collect())
    run_rows = item_rows or max(1, DEFAULT_BLOCK_BYTES // (wide * (width or 1)))
    n_parts = max(1, math.ceil(n_users / (user_rows or max(1024, min(USER_ROWS, math.ceil(n_users / MIN_PARTS))))))
    least = -math.inf if min_score is None else min_score
    schema = "uid int, mid int, score double"

    def run_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (uid, u, bar), (mid, v, block) in groups_of(batches, ("bar",), ("block",)):
            rows, mids, score = best_of_run(u, bar, v, mid, block, n, min_score)
            yield pa.RecordBatch.from_arrays([pa.array(uid[rows], pa.int32()), pa.array(mids, pa.int32()), pa.array(score)], ["uid", "mid", "score"])

    if work is not None:
        work.update(all=n_users * n_items, scored=0)
    open_users = users.withColumn("bar", F.lit(least))
    best, at, size = None, 0, 1
    while at < len(blocks):
        part = blocks[at:at + size]
        runs = runs_of(part, run_rows)
        known = F.array(*[F.struct(F.lit(r).alias("run"), F.lit(run[0][1]).alias("top")) for r, run in enumerate(runs)])
        # no pair of the run can reach the bar if the norms' product does not
        gains = F.filter(known, lambda x: (F.col("norm") * x["top"] * (1 + _SLACK) >= F.col("bar")))
        to = open_users.select("uid", "v", "bar", F.pmod(F.xxhash64("uid"), F.lit(n_parts)).cast("int").alias("part"),
                               F.explode(F.transform(gains, lambda x: x["run"])).alias("run"))
        if work is not None:
            met = {r["run"]: r["count"] for r in to.groupBy("run").count().collect()}
            work["scored"] += sum(met.get(r, 0) * count for r, run in enumerate(runs) for _, _, count in run)
            work["sent"] = work.get("sent", 0) + sum(met.values())
        run_of = F.array(*[F.lit(r) for r, run in enumerate(runs) for _ in run])
        some = items.where(F.col("block").isin([b for b, _, _ in part])).select(
            F.get(run_of, F.col("block") - part[0][0]).alias("run"), F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1))).alias("part"),
            F.lit(1).alias("side"), F.col("mid").alias("k"), "v", F.lit(0.0).alias("bar"), "block")
        both = to.select("run", "part", F.lit(0).alias("side"), F.col("uid").alias("k"), "v", "bar", F.lit(0).alias("block")).unionByName(some)
        both = both.withColumn("g", F.col("run") * n_parts + F.col("part")).drop("run", "part")
        got = dealt_to_tasks(both, len(runs) * n_parts).mapInArrow(run_task, schema)
        got = got if best is None else got.unionByName(best.select("uid", "mid", "score"))
        best = top_n_per_group(got, ["uid"], [F.desc("score"), F.asc("mid")], n).select("uid", "rank", "mid", "score")
        at, size = at + size, GROWTH * (at + size)
        if at < len(blocks):
            best = best.checkpoint()
            bars = best.groupBy("uid").agg(F.max("rank").alias("have"), F.min("score").alias("worst"))
            bar = F.when(F.col("have") == n, F.col("worst")).otherwise(F.lit(least))
            open_users = users.join(bars, "uid", "left").select("uid", "v", "norm", bar.alias("bar"))
            open_users = open_users.where(F.col("norm") * blocks[at][1] * (1 + _SLACK) >= F.col("bar"))
            # the users that can gain, and those that could from the last block too
            left, last = open_users.agg(F.count(F.lit(1)), F.count_if(F.col("norm") * blocks[-1][1] * (1 + _SLACK) >= F.col("bar"))).first()
            if not left:
                break
            if 2 * last >= left:
                size = len(blocks) - at
    return spark.createDataFrame([], "uid int, rank int, mid int, score double") if best is None else best
