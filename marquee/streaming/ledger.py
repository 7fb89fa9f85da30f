"""Spool files admitted by (name, day), with a ledger of every decision.

Spark's file source knows a file by its path and never reads that path again.
Here a file is admitted if no file of its name was read on that day; one that
has to wait is recorded as skipped and is read on a later day, as is a new file
under a path that was read before. Two tables of small rows decide, never the
lines: the listing of the spool folder and the ledger (a keyed log with
snapshots, so its folders stay few).

One ``poll`` is one batch. Its plan (files to read, files skipped) is written
to the ledger, then its lines are delivered under the batch's number, then the
batch is marked as done. A poll that finds a planned batch without its mark
delivers that plan again, so ``deliver`` must replace what it wrote under the
same number, as a ``foreachBatch`` function must. One process polls a spool
folder at a time.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.sinks import keyed_log
from marquee.sinks.folders import delete, list_folder, make_folder, move

ENTRY = "day date, name string, file_path string, modified timestamp, size long, status string"
COLS = [c.split(" ")[0] for c in ENTRY.split(", ")]
READ, SKIPPED = "read", "skipped"


def listing(spark: SparkSession, spool_dir: str, glob: str = "*.txt") -> DataFrame:
    """name, file_path, modified, size of every file below ``spool_dir``
    (recursive). Contents are not read: their column is pruned. Empty files are
    left out and stay where they are: they have no line and take no name."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", glob).load(spool_dir))
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("path").alias("file_path"),
                        F.col("modificationTime").alias("modified"), F.col("length").alias("size"))


def entries(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger: one row per file, state of the file (its modification time)
    and day on which it was read or skipped. Empty before the first batch."""
    if not list_folder(spark, ledger):
        return spark.createDataFrame([], ENTRY)
    return keyed_log.newest(spark, ledger, "entry", COLS, f"entry string, {ENTRY}").select(*COLS)


def decide(files: DataFrame, known: DataFrame, day: date, max_files: int) -> tuple[DataFrame, DataFrame]:
    """(files to read, files skipped) on ``day``. Of the unread files of a name
    the oldest is read (ties: smallest path) unless one was read that day; the
    ``max_files`` oldest of these go first, the rest wait for the next batch.
    Skipped are files whose name is taken, once per day."""
    read = known.where(F.col("status") == READ)
    same_file = ["file_path", "modified"]
    unread = files.join(read.select(*same_file), same_file, "left_anti")
    taken = read.where(F.col("day") == F.lit(day)).select("name").distinct()
    first = (unread.join(taken, "name", "left_anti").groupBy("name")
             .agg(F.min(F.struct("modified", "file_path", "size")).alias("f"))
             .select("name", "f.file_path", "f.modified", "f.size"))
    admitted = first.orderBy("modified", "file_path").limit(max_files)
    told = known.where((F.col("day") == F.lit(day)) & (F.col("status") == SKIPPED)).select(*same_file)
    skipped = (unread.join(first.select(*same_file), same_file, "left_anti").join(told, same_file, "left_anti")
               .select("name", "file_path", "modified", "size"))
    return admitted, skipped


def _marks(spark: SparkSession, ledger: str) -> list[int]:
    return sorted(int(n) for n in list_folder(spark, ledger + ".done") if n.isdigit())


def _plan(spark: SparkSession, ledger: str, batch_id: int) -> DataFrame | None:
    """The stored plan of a batch, if it was written."""
    path = f"{ledger}/run=0/batch_id={batch_id}"
    if not list_folder(spark, path):
        return None
    return spark.read.schema(f"entry string, {ENTRY}").parquet(path)


def _lines(spark: SparkSession, paths: list[str], day: date) -> DataFrame:
    """value, filename, file_path, archive_date, as ``spool_stream`` has them."""
    plain = [re.sub(r"([\\{}\[\]*?])", r"\\\1", p) for p in paths]      # names, not patterns
    return spark.read.text(plain).select(
        "value", F.col("_metadata.file_name").alias("filename"), F.col("_metadata.file_path").alias("file_path"),
        F.lit(day.strftime("%Y-%m-%d")).alias("archive_date"))


def poll(spark: SparkSession, spool_dir: str, ledger: str, deliver: Callable[[DataFrame, int], None],
         day: date | None = None, max_files: int = 100, glob: str = "*.txt", archive_dir: str | None = None,
         compact_every: int = 100) -> int:
    """Deliver the next batch and return how many files it read (0: none waits).

    ``deliver(lines, batch_id)`` gets the lines of at most ``max_files`` files.
    ``day`` is today's UTC date if not given; a batch that is delivered again
    keeps the day it was planned on. With ``archive_dir`` files that were read
    are moved to ``<archive_dir>/<yyyyMMdd>/<name>`` by the poll after."""
    ledger = ledger.rstrip("/")
    day = day or datetime.now(timezone.utc).date()
    marks = _marks(spark, ledger)
    batch_id = (marks[-1] if marks else -1) + 1
    plan = _plan(spark, ledger, batch_id)
    if plan is None:
        known = entries(spark, ledger)
        if archive_dir:
            _archive(spark, listing(spark, spool_dir, glob), known, archive_dir, max_files)
        admitted, skipped = decide(listing(spark, spool_dir, glob), known, day, max_files)
        rows = (admitted.withColumn("status", F.lit(READ)).unionByName(skipped.withColumn("status", F.lit(SKIPPED)))
                .withColumn("day", F.lit(day)))
        entry = F.concat_ws("|", F.col("day").cast("string"), F.col("modified").cast("string"), "file_path")
        keyed_log.write_batch(rows.select(entry.alias("entry"), *COLS), batch_id, ledger)
        plan = _plan(spark, ledger, batch_id)
        if plan is None:            # nothing to read and nothing new to skip
            return 0
    todo = plan.where(F.col("status") == READ).select("file_path", "day").collect()     # at most max_files
    if todo:
        deliver(_lines(spark, [r.file_path for r in todo], todo[0].day), batch_id)
    make_folder(spark, f"{ledger}.done/{batch_id}")
    for old in marks:
        delete(spark, f"{ledger}.done/{old}")
    if (batch_id + 1) % compact_every == 0:
        keyed_log.compact(spark, ledger, batch_id, "entry", COLS, f"entry string, {ENTRY}")
    return len(todo)


def _archive(spark: SparkSession, files: DataFrame, known: DataFrame, archive_dir: str, max_files: int) -> None:
    """Move files of done batches; one batch's worth at a time."""
    read = known.where(F.col("status") == READ).select("file_path", "modified", "day")
    for r in files.join(read, ["file_path", "modified"]).limit(max_files).select("file_path", "name", "day").collect():
        folder = f"{archive_dir.rstrip('/')}/{r.day:%Y%m%d}"
        make_folder(spark, folder)
        move(spark, r.file_path, f"{folder}/{r.name}")


def drain(spark: SparkSession, spool_dir: str, ledger: str, deliver: Callable[[DataFrame, int], None], **options) -> int:
    """Poll until no file waits; returns how many files were read."""
    total = 0
    while n := poll(spark, spool_dir, ledger, deliver, **options):
        total += n
    return total
