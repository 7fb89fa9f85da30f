"""Command-line entry points for the five jobs.

    python -m marquee load        --movies M --ratings R --tags T --out DIR [--permissive]
    python -m marquee statistics  --ratings DIR/Rating --movies DIR/Movie --out DIR
    python -m marquee offline     --ratings DIR/Rating --movies DIR/Movie --out DIR
    python -m marquee realtime    --sims DIR/MovieSims --ratings DIR/Rating --out DIR
                                  --checkpoint CK (--topic recom --bootstrap HOST:PORT | --inbox FOLDER)
                                  [--inflight FOLDER] [--recents FOLDER]
    python -m marquee ingest      --spool FOLDER --checkpoint CK (--topic T --bootstrap HOST:PORT | --sink DIR
                                  [--kind wechat|mail [--bad DIR]])

``--master`` defaults to the one given by spark-submit (or ``local[*]``);
``--once`` processes what is available and stops (streaming jobs).
"""

from __future__ import annotations

import argparse
import os
import sys

from marquee.plans import jobs
from marquee.session import build_session
from marquee.streaming.sources import rating_stream


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m marquee")
    p.add_argument("--master", default=None)
    p.add_argument("--shuffle-partitions", type=int, default=200)
    sub = p.add_subparsers(dest="job", required=True)

    s = sub.add_parser("load")
    s.add_argument("--movies", required=True)
    s.add_argument("--ratings", required=True)
    s.add_argument("--tags", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--permissive", action="store_true")

    for name in ("statistics", "offline"):
        s = sub.add_parser(name)
        s.add_argument("--ratings", required=True)
        s.add_argument("--movies", required=True)
        s.add_argument("--out", required=True)

    s = sub.add_parser("realtime")
    s.add_argument("--sims", required=True)
    s.add_argument("--ratings", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--topic", default="recom")
    s.add_argument("--bootstrap", default=None)
    s.add_argument("--inbox", default=None, help="read rating messages from text files instead of a topic")
    s.add_argument("--inflight", default=None, help="keep the stream's ratings here as history of later batches")
    s.add_argument("--recents", default=None, help="recent lists kept by the recent-state job")
    s.add_argument("--once", action="store_true")

    s = sub.add_parser("ingest")
    s.add_argument("--spool", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--archive", default=None)
    s.add_argument("--topic", default=None)
    s.add_argument("--bootstrap", default=None)
    s.add_argument("--sink", default=None, help="write lines to this folder (parquet) instead of a topic")
    s.add_argument("--max-files", type=int, default=100)
    s.add_argument("--kind", choices=["wechat", "mail"], default=None,
                   help="split lines into this record kind's 14 fields (folder sink)")
    s.add_argument("--bad", default=None, help="keep lines of another field count here (with --kind)")
    s.add_argument("--once", action="store_true")
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    # under spark-submit the master comes from there; run directly, local
    submitted = "PYSPARK_GATEWAY_PORT" in os.environ
    master = args.master or (None if submitted else "local[*]")
    spark = build_session(master, args.shuffle_partitions, app=f"marquee-{args.job}")
    once = {"availableNow": True} if getattr(args, "once", False) else None
    if args.job == "load":
        jobs.load(spark, args.movies, args.ratings, args.tags, args.out,
                  mode="permissive" if args.permissive else "strict")
    elif args.job in ("statistics", "offline"):
        ratings = spark.read.parquet(args.ratings)
        movies = spark.read.parquet(args.movies)
        getattr(jobs, args.job)(spark, ratings, movies, args.out)
    elif args.job == "realtime":
        if args.inbox:
            stream = rating_stream(spark, fmt="text", path=args.inbox)
        else:
            stream = rating_stream(spark, topic=args.topic, **{"kafka.bootstrap.servers": args.bootstrap})
        jobs.realtime(spark, stream, args.sims, args.ratings, args.out, args.checkpoint, trigger=once,
                      inflight_path=args.inflight, recents_path=args.recents).awaitTermination()
    elif args.job == "ingest":
        if args.sink:
            q = jobs.ingest_logs(spark, args.spool, args.checkpoint, sink_fmt="parquet", sink_path=args.sink,
                                 archive_dir=args.archive, max_files=args.max_files, trigger=once,
                                 record_kind=args.kind, bad_path=args.bad)
        else:
            q = jobs.ingest_logs(spark, args.spool, args.checkpoint, sink_fmt="kafka", topic=args.topic,
                                 archive_dir=args.archive, max_files=args.max_files, trigger=once,
                                 sink_options={"kafka.bootstrap.servers": args.bootstrap})
        q.awaitTermination()
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
