"""The recommender's inputs, derived by Spark from the driver's parquet
tables (whole tables, no sampling):

* ratings      lineitem JOIN orders: uid = o_custkey, mid = l_partkey,
               score = ceil(l_quantity / 10), timestamp = epoch s of l_shipdate
* movies       part: mid = p_partkey, genres = p_type || '|' || p_brand
* tags         lineitem JOIN orders: tag = o_orderpriority
* features     embeddings: mid = vec_id, 8 doubles, each the sum of one
               eighth of the 64 entries (every entry used)
* rating log   events: uid = user_id, mid = event_id mod |embeddings|,
               score = least(5, 0.5 + floor(value / 10) * 0.5)
* log lines    lineitem JOIN orders as 14 tab-separated text fields
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions.expr import epoch_seconds, fold_vector

FEATURE_DIMS = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _line_orders(spark: SparkSession, sf_dir: str, line_cols, order_cols) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(*line_cols)
    od = table(spark, sf_dir, "orders").select(*order_cols)
    # Both sides grow with the data (orders is a quarter of lineitem), so
    # nothing is broadcast by a hint: Spark and AQE choose the join from
    # the measured sizes.
    return li.join(od, li.l_orderkey == od.o_orderkey)


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _line_orders(spark, sf_dir, ["l_orderkey", "l_partkey", "l_quantity", "l_shipdate"],
                      ["o_orderkey", "o_custkey"])
    return df.select(
        F.col("o_custkey").cast("int").alias("uid"),
        F.col("l_partkey").cast("int").alias("mid"),
        F.ceil(F.col("l_quantity") / 10).cast("double").alias("score"),
        epoch_seconds("l_shipdate").cast("int").alias("timestamp"),
    )


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    empty = F.lit("")
    return p.select(
        F.col("p_partkey").cast("int").alias("mid"),
        F.col("p_name").alias("name"),
        empty.alias("descri"),
        F.col("p_size").cast("string").alias("timelong"),
        empty.alias("issue"),
        empty.alias("shoot"),
        empty.alias("language"),
        F.concat_ws("|", "p_type", "p_brand").alias("genres"),
        empty.alias("actors"),
        empty.alias("direstors"),
    )


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _line_orders(spark, sf_dir, ["l_orderkey", "l_partkey"],
                      ["o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate"])
    return df.select(
        F.col("o_custkey").cast("int").alias("uid"),
        F.col("l_partkey").cast("int").alias("mid"),
        F.col("o_orderpriority").alias("tag"),
        epoch_seconds("o_orderdate").cast("int").alias("timestamp"),
    )


def item_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        F.col("vec_id").cast("int").alias("mid"),
        fold_vector("embedding", FEATURE_DIMS).alias("features"),
    )


def n_items(spark: SparkSession, sf_dir: str) -> Column:
    """Number of items, as a scalar subquery (run once per query)."""
    return table(spark, sf_dir, "embeddings").select(F.count(F.lit(1))).scalar()


def rating_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timestamped rating events: uid, mid, score, timestamp, ts, event_id."""
    return rating_events(table(spark, sf_dir, "events"), n_items(spark, sf_dir))


def rating_events(events: DataFrame, n_items) -> DataFrame:
    """``events`` rows (batch or streaming) as rating events."""
    ev = events.select("event_id", "user_id", "ts", "value")
    return ev.select(
        F.col("user_id").cast("int").alias("uid"),
        F.pmod(F.col("event_id"), F.lit(n_items)).cast("int").alias("mid"),
        F.least(F.lit(5.0), F.lit(0.5) + F.floor(F.col("value") / 10) * 0.5).cast("double").alias("score"),
        epoch_seconds("ts").cast("int").alias("timestamp"),
        "ts",
        "event_id",
    )


def log_lines(spark: SparkSession, sf_dir: str, delim: str = "\t") -> DataFrame:
    """One text line per line item: its 11 columns and 3 of its order,
    each written with a fixed format, joined by ``delim``."""
    df = _line_orders(
        spark, sf_dir,
        ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
         "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"],
        ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"],
    )
    fields = [
        F.col("l_orderkey").cast("string"),
        F.col("l_partkey").cast("string"),
        F.col("l_suppkey").cast("string"),
        F.col("l_linenumber").cast("string"),
        F.col("l_quantity").cast("decimal(18,2)").cast("string"),
        F.col("l_extendedprice").cast("decimal(18,2)").cast("string"),
        F.col("l_discount").cast("decimal(18,2)").cast("string"),
        F.col("l_tax").cast("decimal(18,2)").cast("string"),
        F.col("l_returnflag"),
        F.col("l_linestatus"),
        F.date_format("l_shipdate", "yyyy-MM-dd"),
        F.col("o_custkey").cast("string"),
        F.col("o_orderstatus"),
        F.col("o_orderpriority"),
    ]
    return df.select(F.concat_ws(delim, *fields).alias("value"))
