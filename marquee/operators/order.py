"""Positions in a total order without a window over all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_position(df: DataFrame, order: Sequence[Column], path: str, groups: Sequence[str] = (),
                  name: str = "position", partitions: int | None = None) -> DataFrame:
    """``df`` with each row's 1-based place in ``order``, within its group if
    ``groups`` are named (null is a group). End ``order`` with a unique column,
    else rows that tie are numbered as they come.

    Rows are range-partitioned and sorted, and stored under ``path`` with their
    place in their partition, so that no later step can deal them otherwise. A
    row's position is that place plus the rows of its group in the partitions
    before. Only those counts, one row for a group and partition, pass a
    window; a hot group is spread over as many partitions as it fills."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    at, part = f"{name}__at", f"{name}__part"
    keys = [*(F.col(g).asc() for g in groups), *order]
    dealt = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    dealt.withColumn(at, F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path).withColumn(part, F.shiftright(at, 33))      # the id's upper bits are the partition
    runs = rows.groupBy(*groups, part).agg(F.count(F.lit(1)).alias("n"), F.min(at).alias("first"))
    before = Window.partitionBy(*groups).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(*[F.col(g).alias(f"{name}__{g}") for g in groups], F.col(part).alias(f"{name}__run"),
                       (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first") + 1).alias(f"{name}__shift"))
    same = F.col(part) == F.col(f"{name}__run")
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"{name}__{g}"))
    return rows.join(runs, same).withColumn(name, F.col(at) + F.col(f"{name}__shift")).select(*df.columns, name)
