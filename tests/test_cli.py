"""The command line runs a job end to end in its own process."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_cli_load_then_statistics(tmp_dir):
    for name, text in (("movies", "1^Heat^^^^^^Drama|Action^^\n2^Up^^^^^^Family^^\n"),
                       ("ratings", "1,1,4.0,1564412033\n2,1,5.0,1564412033\n1,2,3.0,1564412033\n"),
                       ("tags", "1,1,tense,1564412033\n")):
        os.makedirs(os.path.join(tmp_dir, name))
        with open(os.path.join(tmp_dir, name, "part.txt"), "w") as f:
            f.write(text)
    out = os.path.join(tmp_dir, "out")
    env = dict(os.environ, PYTHONPATH=REPO)
    base = [sys.executable, "-m", "marquee", "--master", "local[2]", "--shuffle-partitions", "4"]
    subprocess.run(base + ["load", "--movies", f"{tmp_dir}/movies", "--ratings", f"{tmp_dir}/ratings",
                           "--tags", f"{tmp_dir}/tags", "--out", out], check=True, env=env, cwd=tmp_dir,
                   timeout=600, capture_output=True)
    subprocess.run(base + ["statistics", "--ratings", f"{out}/Rating", "--movies", f"{out}/Movie", "--out", out],
                   check=True, env=env, cwd=tmp_dir, timeout=600, capture_output=True)
    for name in ("search", "ratingScore", "popularMovie", "avgScore", "GenretopTen"):
        assert os.path.isdir(os.path.join(out, name)), name
    subprocess.run(base + ["offline", "--ratings", f"{out}/Rating", "--movies", f"{out}/Movie", "--out", out],
                   check=True, env=env, cwd=tmp_dir, timeout=900, capture_output=True)
    assert os.path.isdir(os.path.join(out, "UserRecms")) and os.path.isdir(os.path.join(out, "MovieSims"))
    inbox = os.path.join(tmp_dir, "inbox")
    os.makedirs(inbox)
    with open(os.path.join(inbox, "m.txt"), "w") as f:
        f.write("2|2|4.0|1564412099\n")
    subprocess.run(base + ["realtime", "--sims", f"{out}/MovieSims", "--ratings", f"{out}/Rating", "--out", out,
                           "--checkpoint", f"{tmp_dir}/ck", "--inbox", inbox, "--once"],
                   check=True, env=env, cwd=tmp_dir, timeout=600, capture_output=True)
    assert os.path.isdir(os.path.join(out, "StreamRecms", "run=0", "batch_id=0"))


def test_cli_ingest_to_folder(tmp_dir):
    spool = os.path.join(tmp_dir, "spool", "day1")
    os.makedirs(spool)
    with open(os.path.join(spool, "a.txt"), "w") as f:
        f.write("first line\nsecond line\n")
    env = dict(os.environ, PYTHONPATH=REPO)
    subprocess.run([sys.executable, "-m", "marquee", "--master", "local[2]", "--shuffle-partitions", "4", "ingest",
                    "--spool", os.path.join(tmp_dir, "spool"), "--checkpoint", os.path.join(tmp_dir, "ck"),
                    "--sink", os.path.join(tmp_dir, "out"), "--once"],
                   check=True, env=env, cwd=tmp_dir, timeout=600, capture_output=True)
    import pyarrow.parquet as pq
    table = pq.read_table(os.path.join(tmp_dir, "out"))
    assert sorted(table.column("value").to_pylist()) == ["first line", "second line"]
    assert set(table.column("filename").to_pylist()) == {"a.txt"}
