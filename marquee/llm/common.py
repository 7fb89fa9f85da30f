"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import functools
import gc
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.session import scratch_root, ship_package

ASCII_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, with the package shipped to the executors first."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (names are case-insensitive)."""
    taken = {c.lower() for c in df.columns}
    name, n = base, 0
    while name.lower() in taken:
        n += 1
        name = f"{base}_{n}"
    return name


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def release() -> None:
    """Gives memory that this process has freed back to the system, as far as its allocators can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(task):
    """Wraps a generator that a task runs: Python workers live on from stage to
    stage, so each begins and ends without what earlier ones have freed."""
    @functools.wraps(task)
    def run(*args):
        release()
        yield from task(*args)
        release()

    return run


class Scratch:
    """Tables of one run in the shared scratch folder.

    ``keep`` writes a DataFrame and reads it back, which cuts the lineage with
    files that every executor sees. Leaving the ``with`` block deletes all of
    them but those kept with ``result=True``, which the caller still reads.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
        self.names: list[str] = []
        self.tables: list[str] = []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_exc) -> None:
        for t in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {t}")
        for path in self.names:
            self.delete(path)

    def path(self, name: str, result: bool = False) -> str:
        path = f"{self.root}/{'result' if result else name}-{len(self.names)}"
        if not result:
            self.names.append(path)
        return path

    def delete(self, path: str) -> None:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)

    def keep(self, df: DataFrame, name: str = "t", result: bool = False) -> DataFrame:
        path = self.path(name, result)
        df.write.parquet(path)
        self.tidy()
        out = self.spark.read.schema(df.schema).parquet(path)
        if result:
            out.stored_at = path
        return out

    def bucketed(self, df: DataFrame, *keys: str) -> DataFrame:
        """``df`` stored by hash of the keys in as many buckets as a shuffle has
        partitions: later joins on them move only the other side. Pass rows
        that are already dealt by these keys, in this order. Dropped with its
        files at the end of the block."""
        name = f"marquee_llm_{uuid.uuid4().hex[:12]}"
        self.tables.append(name)
        (df.write.format("parquet").option("compression", "zstd").option("path", self.path(name))
         .bucketBy(shuffle_partitions(self.spark), *keys).saveAsTable(name))
        self.tidy()
        return self.spark.table(name)

    def discard(self, df: DataFrame) -> None:
        """Deletes a result that nobody reads any more; other tables stay."""
        path = getattr(df, "stored_at", None)
        if path:
            self.delete(path)

    def drop(self, df) -> None:
        """Deletes the files of one stored table before the block ends."""
        for f in df.inputFiles()[:1]:
            folder = f.rsplit("/", 1)[0]
            if f"/{self.root.rsplit('/', 1)[-1]}/" in folder:
                self.delete(folder)

    def tidy(self) -> None:
        """What is stored no longer needs its shuffles; Spark deletes their
        files when the driver's garbage is collected."""
        gc.collect()
        self.spark._jvm.System.gc()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
