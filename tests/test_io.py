"""Sources and sinks: typed table scan, views, table replace, search
documents, lines to a (file) topic, compaction of the upsert log."""

import os

import pytest

from marquee.schemas import RATING
from marquee.sinks.tables import write_lines_to_topic, write_search_docs, write_table
from marquee.sources.tables import read_table, register_views
from marquee.streaming.realtime import compact, current_stream_recs, upsert_stream_recs


def test_read_table_casts_to_schema_and_views(spark, tmp_dir):
    path = os.path.join(tmp_dir, "r")
    spark.createDataFrame([(1, 2, 4, 10, "x")], "uid long, mid long, score long, timestamp long, extra string") \
        .write.parquet(path)
    df = read_table(spark, path, RATING)
    assert df.dtypes == [("uid", "int"), ("mid", "int"), ("score", "double"), ("timestamp", "int")]
    register_views(spark, ratings=df)
    assert spark.sql("SELECT count(1) AS n FROM ratings").first().n == 1


def test_write_table_replaces(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    write_table(spark.range(3), path)
    write_table(spark.range(2), path)
    assert spark.read.parquet(path).count() == 2


def test_replace_drops_stale_partitions(spark, tmp_dir):
    from marquee.streaming.realtime import write_history
    path = os.path.join(tmp_dir, "h")
    write_history(spark.createDataFrame([(u, 1, 1.0, 1) for u in range(50)], "uid int, mid int, score double, timestamp int"),
                  path, 8)
    write_history(spark.createDataFrame([(1, 1, 1.0, 1)], "uid int, mid int, score double, timestamp int"), path, 8)
    assert spark.read.parquet(path).count() == 1
    part = os.path.join(tmp_dir, "p")
    write_table(spark.range(4).selectExpr("id", "id % 2 AS k"), part, partition_by=["k"])
    write_table(spark.range(1).selectExpr("id", "id % 2 AS k"), part, partition_by=["k"])
    assert spark.read.parquet(part).count() == 1


def test_search_docs_unique_ids(spark, tmp_dir):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "mid int, name string")
    write_search_docs(docs, os.path.join(tmp_dir, "s"))
    assert spark.read.json(os.path.join(tmp_dir, "s")).count() == 2
    dup = spark.createDataFrame([(1, "a"), (1, "b")], "mid int, name string")
    with pytest.raises(ValueError):
        write_search_docs(dup, os.path.join(tmp_dir, "s2"))


def test_lines_to_file_topic(spark, tmp_dir):
    lines = spark.createDataFrame([("a",), ("b",)], "value string")
    write_lines_to_topic(lines, "logs", fmt="text", path=os.path.join(tmp_dir, "topic"))
    assert sorted(r.value for r in spark.read.text(os.path.join(tmp_dir, "topic")).collect()) == ["a", "b"]


def test_upsert_replay_and_compact(spark, tmp_dir):
    path = os.path.join(tmp_dir, "recs")

    def put(rows, batch_id):
        upsert_stream_recs(spark.createDataFrame(rows, "uid int, recms string"), batch_id, path)

    def current():
        return {r.uid: r.recms for r in current_stream_recs(spark, path).collect()}

    put([(1, "5:1.0"), (2, "")], 0)
    put([(1, "7:2.0")], 1)
    put([(1, "7:2.0")], 1)                                  # a replay rewrites batch 1
    assert spark.read.parquet(path).count() == 3
    assert current() == {1: "7:2.0", 2: ""}
    compact(spark, path, 1)
    put([(2, "9:3.0"), (3, "")], 2)
    assert current() == {1: "7:2.0", 2: "9:3.0", 3: ""}
    # reads start from the snapshot: log partitions up to batch 1 are pruned
    plan = current_stream_recs(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "batch_id#" in plan and "> 1" in plan
    compact(spark, path, 2)
    assert current() == {1: "7:2.0", 2: "9:3.0", 3: ""}


def test_keyed_log_with_only_empty_batches(spark, tmp_dir):
    path = os.path.join(tmp_dir, "empty")
    upsert_stream_recs(spark.createDataFrame([], "uid int, recms string"), 0, path)
    assert current_stream_recs(spark, path).count() == 0
    compact(spark, path, 0)
    upsert_stream_recs(spark.createDataFrame([(4, "1:1.0")], "uid int, recms string"), 1, path)
    assert [tuple(r) for r in current_stream_recs(spark, path).collect()] == [(4, "1:1.0")]
