"""Spool files by (name, day): admission, waiting, replay, archive."""

import os
from datetime import date

from marquee.sinks import keyed_log
from marquee.streaming import ledger as lg

MONDAY, TUESDAY = date(2024, 1, 1), date(2024, 1, 2)


class Spool:
    def __init__(self, spark, root):
        self.spark, self.spool, self.ledger = spark, os.path.join(root, "spool"), os.path.join(root, "ledger")
        self.out, self.clock, self.fail = os.path.join(root, "out"), 1_700_000_000, False

    def put(self, path, text):
        full = os.path.join(self.spool, path)
        os.makedirs(os.path.dirname(full), exist_ok=True)
        with open(full, "w") as f:
            f.write(text)
        self.clock += 10
        os.utime(full, (self.clock, self.clock))

    def deliver(self, lines, batch_id):
        keyed_log.write_batch(lines, batch_id, self.out)
        if self.fail:
            raise RuntimeError("lost after the write, before the mark")

    def drain(self, day, **options):
        return lg.drain(self.spark, self.spool, self.ledger, self.deliver, day=day, **options)

    def lines(self):
        return sorted((r.value, r.filename, r.archive_date) for r in self.spark.read.parquet(self.out).collect())

    def decisions(self):
        return sorted((str(r.day), r.file_path.split("/spool/")[1], r.status)
                      for r in lg.entries(self.spark, self.ledger).collect())


def test_a_name_is_read_once_a_day(spark, tmp_dir):
    s = Spool(spark, tmp_dir)
    s.put("a/app.txt", "one\n")
    s.put("b/app.txt", "two\n")
    s.put("b/skip.csv", "not a text file\n")
    assert s.drain(MONDAY) == 1 and s.drain(MONDAY) == 0
    assert s.decisions() == [("2024-01-01", "a/app.txt", "read"), ("2024-01-01", "b/app.txt", "skipped")]
    s.put("a/app.txt", "three\n")                      # the same path again, the same day: waits as well
    assert s.drain(MONDAY) == 0
    assert s.drain(TUESDAY) == 1                       # the older of the two that wait
    assert s.drain(date(2024, 1, 3)) == 1 and s.drain(date(2024, 1, 4)) == 0
    assert s.lines() == [("one", "app.txt", "2024-01-01"), ("three", "app.txt", "2024-01-03"),
                         ("two", "app.txt", "2024-01-02")]


def test_a_lost_batch_is_delivered_again_and_only_once(spark, tmp_dir):
    s = Spool(spark, tmp_dir)
    for n in range(5):
        s.put(f"f{n}.txt", f"line {n}\n")
    s.fail = True
    try:
        s.drain(MONDAY, max_files=2)
    except RuntimeError:
        pass
    assert len(s.lines()) == 2
    s.fail = False
    s.put("early.txt", "late comer\n")
    assert s.drain(TUESDAY, max_files=2, compact_every=2) == 6       # two of them again, on their own day
    want = [("line 0", "f0.txt", "2024-01-01"), ("line 1", "f1.txt", "2024-01-01")]
    want += [(f"line {n}", f"f{n}.txt", "2024-01-02") for n in range(2, 5)]
    assert s.lines() == [("late comer", "early.txt", "2024-01-02"), *want]
    assert len(s.decisions()) == 6 and os.listdir(s.ledger + ".done") == ["2"]


def test_archive_by_day_and_names_with_pattern_characters(spark, tmp_dir):
    s = Spool(spark, tmp_dir)
    archive = os.path.join(tmp_dir, "archive")
    s.put("x/a[1] b.txt", "odd name\n")
    s.put("x/empty.txt", "")
    s.put("x/a1 b.txt", "plain name\n")
    assert s.drain(MONDAY, archive_dir=archive) == 2          # the empty file takes part in nothing
    assert [v for v, _, _ in s.lines()] == ["odd name", "plain name"]
    moved = lambda day: sorted(x for x in os.listdir(os.path.join(archive, day)) if not x.startswith("."))
    assert moved("20240101") == ["a1 b.txt", "a[1] b.txt"]
    assert [x for x in os.listdir(os.path.join(s.spool, "x")) if not x.startswith(".")] == ["empty.txt"]
    s.put("x/a1 b.txt", "next day\n")
    assert s.drain(TUESDAY, archive_dir=archive) == 1
    assert [(v, d) for v, _, d in s.lines()] == [("next day", "2024-01-02"), ("odd name", "2024-01-01"),
                                                 ("plain name", "2024-01-01")]
    assert moved("20240102") == ["a1 b.txt"]


def test_an_empty_folder_has_no_batch(spark, tmp_dir):
    s = Spool(spark, tmp_dir)
    os.makedirs(s.spool)
    assert s.drain(MONDAY) == 0 and s.decisions() == []
