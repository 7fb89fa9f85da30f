"""Positions against a plain sort."""

from pyspark.sql import functions as F

from marquee.operators.order import with_position


def test_positions_are_those_of_a_sort(spark, tmp_dir):
    df = spark.range(5000).select(F.col("id"), (F.col("id") * 7919 % 31).alias("v"), F.lit("mine").alias("n"))
    got = with_position(df, [F.desc("v"), F.asc("id")], f"{tmp_dir}/a", partitions=7)
    assert got.columns == ["id", "v", "n", "position"]
    rows = sorted(got.collect(), key=lambda r: r["position"])
    assert [r["position"] for r in rows] == list(range(1, 5001))
    assert [(r["v"], r["id"]) for r in rows] == sorted(((r["v"], r["id"]) for r in rows), key=lambda x: (-x[0], x[1]))


def test_positions_within_groups(spark, tmp_dir):
    # one group holds most rows; null is a group of its own
    group = F.when(F.col("id") % 10 < 8, F.lit("hot")).when(F.col("id") % 10 == 8, F.col("id").cast("string"))
    df = spark.range(3000).select("id", group.alias("g"))
    got = with_position(df, [F.desc("id")], f"{tmp_dir}/b", groups=["g"], name="rank", partitions=6).collect()
    want: dict = {}
    for r in sorted(got, key=lambda r: -r["id"]):
        want.setdefault(r["g"], []).append(r["rank"])
    assert all(ranks == list(range(1, len(ranks) + 1)) for ranks in want.values())
    assert len(want["hot"]) == 2400 and len(want[None]) == 300


def test_empty_table(spark, tmp_dir):
    assert with_position(spark.range(0), [F.asc("id")], f"{tmp_dir}/c").count() == 0
