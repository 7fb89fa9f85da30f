"""Log ingest: spool folder -> (typed records) -> topic or table.

A checkpointed file-stream query replaces the poll / move / hand-off loop:
files are admitted once by name, every line of a micro-batch is delivered
by the sink before the batch commits, and a failed batch is replayed from
the checkpoint (at-least-once to a topic, exactly-once to a file sink).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from marquee.sinks import keyed_log
from marquee.sources.text import typed_log_records
from marquee.streaming.sources import spool_stream

# Fixed value: spool poll interval.
POLL = "2 seconds"


def ingest_logs(
    spark: SparkSession,
    spool_dir: str,
    checkpoint: str,
    sink_fmt: str = "kafka",
    topic: str | None = None,
    sink_path: str | None = None,
    archive_dir: str | None = None,
    max_files: int = 100,
    record_kind: str | None = None,
    delim: str = "\t",
    trigger: dict | None = None,
    sink_options: dict | None = None,
    bad_path: str | None = None,
) -> StreamingQuery:
    """Start the ingest query.

    ``sink_fmt='kafka'`` sends each line as a message value (null key) to
    ``topic`` (typed fields are not sent, only the line); any file format
    appends rows to ``sink_path``. With
    ``record_kind`` ('wechat' or 'mail') lines are split into the kind's
    named fields first: each micro-batch writes its typed rows under
    ``sink_path`` and the lines with another field count, with the reason,
    under ``bad_path`` (by default ``sink_path`` + ``.rejected``), both as
    parquet partition ``run=R/batch_id=N``, so a replay rewrites the same
    partitions and good and rejected rows add up to the lines read."""
    if record_kind and not bad_path and sink_fmt != "kafka":
        bad_path = sink_path.rstrip("/") + ".rejected"
    lines = spool_stream(spark, spool_dir, archive_dir, max_files)
    if record_kind and bad_path:
        if sink_fmt == "kafka":
            raise ValueError("bad_path needs a table sink, not a topic")
        keep = ["filename", "file_path", "archive_date"]

        def handle(batch: DataFrame, batch_id: int) -> None:
            run = keyed_log.run_number(batch.sparkSession, sink_path, checkpoint)
            batch = batch.persist()
            try:
                good, bad = typed_log_records(batch, record_kind, delim, "permissive", keep=keep)
                keyed_log.write_batch(good, batch_id, sink_path, run)
                keyed_log.write_batch(bad, batch_id, bad_path, run)
            finally:
                batch.unpersist()

        w = lines.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
        return w.trigger(**(trigger or {"processingTime": POLL})).start()
    if sink_fmt == "kafka":
        w = (lines.selectExpr("CAST(value AS STRING) AS value").writeStream
             .format("kafka").option("topic", topic))
    else:
        w = lines.writeStream.format(sink_fmt).option("path", sink_path).outputMode("append")
    w = w.option("checkpointLocation", checkpoint).options(**(sink_options or {}))
    return w.trigger(**(trigger or {"processingTime": POLL})).start()
