"""Operators with exact contracts against brute force."""

import hashlib
import re
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.llm import bpe, decontaminate, jaccard, sarray, shingles, tokens, warc
from marquee.llm.common import Scratch


def test_suffixes_match_brute_force(spark, nasty, nasty_df):
    raw = [(t or "").encode() for _, t in nasty]
    seen = Counter(b[i:i + 200] for b in raw for i in range(len(b) - 199))
    want = Counter()
    for (d, _), b in zip(nasty, raw):
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 199):
            if seen[b[i:i + 200]] > 1:
                gone[i:i + 200] = True
        runs = int((np.diff(np.concatenate(([0], gone.astype(np.int8)))) == 1).sum())
        want[(d, len(b), int(gone.sum()), runs, bytes(np.frombuffer(b, np.uint8)[~gone]))] += 1
    with Scratch(spark, "t") as s:
        got = sarray.remove_repeats(nasty_df, "cut", s, batches=4)
        assert got.columns == [*nasty_df.columns, "cut"]
        rows = Counter((r["doc_id"], r["cut"]["n_bytes"], r["cut"]["n_removed"], len(r["cut"]["spans"]), bytes(r["cut"]["kept"]))
                       for r in got.collect())
    assert rows == want


def test_suffixes_of_periodic_and_tiled_text(spark, monkeypatch):
    rng = random.Random(3)
    noise = bytes(rng.choices(b"abcdefgh ", k=700)).decode()
    docs = [(1, "ab" * 600 + noise), (2, "x" * 450), (3, noise[:350] + "y" * 250), (4, "q" * 199), (5, "z" * 200)]
    seen = Counter(t[i:i + 200] for _, t in docs for i in range(len(t) - 199))
    want = {}
    for d, t in docs:
        gone = {j for i in range(len(t) - 199) if seen[t[i:i + 200]] > 1 for j in range(i, i + 200)}
        want[d] = "".join(c for i, c in enumerate(t) if i not in gone)
    for tile in (1 << 17, 300):            # a long document is worked on in overlapping tiles
        monkeypatch.setattr(sarray, "TILE", tile)
        entries = list(sarray._suffixes(iter([_batch(docs)]), 1))
        assert sum(int(h - lo + 1) for b in entries for lo, h in zip(b.column(3).to_pylist(), b.column(4).to_pylist())) == \
            sum(max(0, len(t) - 199) for _, t in docs)
    with Scratch(spark, "t") as s:
        got = sarray.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"), "cut", s, batches=3)
        assert {r["doc_id"]: bytes(r["cut"]["kept"]).decode() for r in got.collect()} == want


def _batch(rows):
    import pyarrow as pa

    a, b = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.string())], names=["row", "text"])


@pytest.mark.parametrize("k,num,den", [(4, 85, 100), (5, 80, 100)])
def test_jaccard_components_match_brute_force(spark, nasty, nasty_df, k, num, den):
    sets = [shingles.exact_shingles(t, k) for _, t in nasty]
    up = list(range(len(nasty)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and den * len(a & b) >= num * len(a | b):
                up[root(i)] = root(j)
    groups = defaultdict(list)
    for i in range(len(nasty)):
        groups[root(i)].append(i)
    least = {i: min((nasty[j][0] for j in g if nasty[j][0] is not None), default=None) for g in groups.values() for i in g}
    want = Counter((d, len(s), least[i] if s else d) for i, ((d, _), s) in enumerate(zip(nasty, sets)))
    with Scratch(spark, "t") as s:
        stored, got, row = jaccard.near_duplicates(nasty_df, s, k=k, num=num, den=den)
        assert set(nasty_df.columns) < set(stored.columns)
        ids = stored.select(F.col(row).alias("row"), F.col("doc_id"))
        rows = ids.join(got, "row").collect()
        assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows) == want
        assert sum(r["first"] for r in rows) == sum(1 if sets[g[0]] else len(g) for g in groups.values())


def test_hot_groups_keep_every_link(spark, monkeypatch):
    """Small HOT: most groups are hot, and links must still all be found."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(300)]
    docs = []
    for i in range(50):
        w = list(base)
        for _ in range(rng.randrange(1, 14)):
            w[rng.randrange(300)] = f"e{rng.randrange(10**6)}"
        docs.append((i, " ".join(w)))
    for i in range(50, 90):
        docs.append((i, " ".join(base[:100] + [f"o{i}_{j}" for j in range(rng.randrange(20, 200))])))
    sets = [shingles.exact_shingles(t, 4) for _, t in docs]
    up = list(range(90))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(90):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    monkeypatch.setattr(jaccard, "HOT", 3)
    got = list(jaccard._groups(iter([_keys_batch([(1, r, 5, 2) for r in range(5)] + [(2, 9, 5, 2), (2, 10, 5, 2)])])))
    assert [x for b in got for x in b.column(0).to_pylist()].count("member") == 5
    with Scratch(spark, "t") as s:
        df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
        stored, res, row = jaccard.near_duplicates(df, s, k=4, num=85, den=100)
        ids = stored.select(F.col(row).alias("row"), "doc_id")
        assert {r["doc_id"]: r["component_id"] for r in ids.join(res, "row").collect()} == {i: root(i) for i in range(90)}


def _keys_batch(rows):
    import pyarrow as pa

    c = list(zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(c[0], pa.int64()), pa.array(c[1], pa.int64()), pa.array(c[2], pa.int32()),
                                       pa.array(c[3], pa.int32())], names=["key", "row", "band", "slack"])


def test_bit_sketch_bounds_the_difference():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a = rng.integers(0, 1 << 63, rng.integers(1, 300), dtype=np.uint64)
        b = np.unique(np.concatenate((a[: len(a) // 2], rng.integers(0, 1 << 63, rng.integers(1, 300), dtype=np.uint64))))
        a = np.unique(a)
        assert jaccard.hamming(jaccard.bit_sketch(a), jaccard.bit_sketch(b)) <= len(np.setxor1d(a, b))


def _decontaminated(items, docs):
    import re

    rx = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    low = lambda t: rx.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    win = defaultdict(set)
    for i, t in items:
        w = low(t)
        for s in range(max(1, len(w) - 9) if w else 0):
            win[tuple(w[s:s + 10])].add(str(i) if i is not None else "")
    out = Counter()
    for d, t in docs:
        w, hit, ids = low(t), set(), set()
        for x, names in win.items():
            for s in range(len(w) - len(x) + 1):
                if tuple(w[s:s + len(x)]) == x:
                    hit.update(range(s, s + len(x)))
                    ids |= names
        out[(d, len(w), len(hit), tuple(sorted(ids)))] += 1
    return out


@pytest.mark.parametrize("block_bytes", [32 << 20, 600])
def test_decontamination_matches_brute_force(spark, nasty, nasty_df, block_bytes):
    near = nasty[5][1].split(" ")
    items = [(1, " ".join(near[10:31])), (2, "One TWO three"), (3, None), (4, ""), (None, "no id"), (5, " ".join(near[25:36])),
             (5, "tail, of: a copy"), (6, "東京 x1"), (7, "the"), (8, " ".join(near[25:36]))]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("win", F.lit(1))
    with Scratch(spark, "t") as s:
        got = decontaminate.contamination(nasty_df, bench, "found", s, block_bytes=block_bytes)
        assert got.columns == [*nasty_df.columns, "found"]
        rows = got.collect()
    assert Counter((r["doc_id"], r["found"]["n_words"], r["found"]["n_hit"], tuple(r["found"]["items"])) for r in rows) == \
        _decontaminated(items, nasty)
    for r in rows:
        assert sum(x["last"] - x["first"] + 1 for x in r["found"]["spans"]) == r["found"]["n_hit"]


@pytest.mark.parametrize("chunk,overlap", [(1 << 15, 1 << 10), (64, 16), (7, 3)])
def test_bpe_is_the_librarys_and_round_trips(spark, nasty, nasty_df, chunk, overlap):
    enc = bpe.encoder()
    want = Counter((d, tuple(enc.encode_ordinary(t or "")), (t or "").encode()) for d, t in nasty)
    docs = nasty_df if chunk > 7 else nasty_df.where("coalesce(length(text), 0) < 4000")
    if chunk <= 7:
        want = Counter({k: n for k, n in want.items() if len(k[2].decode()) < 4000})
    with Scratch(spark, "t") as s:
        got = bpe.encode(docs, "ids", s, chunk=chunk, overlap=overlap)
        assert got.columns == [*nasty_df.columns, "ids"]
        rows = got.withColumn("back", bpe.decode()("ids")).select("doc_id", "ids", "back").collect()
    assert Counter((r["doc_id"], tuple(np.frombuffer(r["ids"], "<u4").tolist()), bytes(r["back"])) for r in rows) == want


def test_chunk_cuts_at_contractions_and_space_runs(spark):
    rng = random.Random(2)
    bits = ["'re", "'ll", "don't", " ", "  ", "\n", "\n\n ", "we'", "''s", "x", "12", "é", "\x1c", " ", "!?", "a" * 30, " " * 20]
    docs = [(i, "".join(rng.choices(bits, k=200))) for i in range(60)]
    enc = bpe.encoder()
    with Scratch(spark, "t") as s:
        got = bpe.encode(spark.createDataFrame(docs, "doc_id long, text string"), "ids", s, chunk=50, overlap=12).collect()
    assert {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in got} == {d: enc.encode_ordinary(t) for d, t in docs}


def test_dac_gives_any_id_and_any_range():
    rng = np.random.default_rng(4)
    for n in (0, 1, 511, 512, 513, 5000):
        ids = (rng.integers(0, 1 << 32, n) >> rng.integers(0, 32, n)).astype("<u4")
        d = tokens.Dac(tokens.encode_dac(ids))
        assert len(d) == n and [d[i] for i in range(0, n, 7)] == ids[::7].tolist()
        for i, j in [(0, n), (n // 3, n // 2), (n, n)]:
            assert (d.slice(i, j) == ids[i:j]).all()


def test_token_store_round_trips_in_order(spark, nasty, nasty_df):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.TOKENIZER)
    t.encode_special_tokens = True
    want = Counter((d, zlib.crc32(np.array([*t.encode(x or "", add_special_tokens=False).ids, 2], "<u4").tobytes())) for d, x in nasty)
    with Scratch(spark, "t") as s:
        path = s.path("store")
        tokens.write_tokens(nasty_df, path, segment=500)
        seg = tokens.read_segments(spark, path)
        rows = seg.select("start", "n", "doc_ids", "starts", "dac").mapInArrow(
            tokens._documents, "doc_id long, start long, n_tokens long, ids_crc32 long").orderBy("start").collect()
        assert Counter((r["doc_id"], r["ids_crc32"]) for r in rows) == want
        ids = [r["doc_id"] for r in rows]
        assert ids == sorted(ids, key=lambda x: (x is not None, x or 0))
        assert [r["start"] for r in rows] == np.cumsum([0, *(r["n_tokens"] for r in rows)])[:-1].tolist()
        at = [0, 5, rows[-1]["start"], 10**9]
        got = {r["at"]: r["id"] for r in tokens.tokens_at(spark, path, spark.createDataFrame([(x,) for x in at], "at long")).collect()}
        assert set(got) == {0, 5, rows[-1]["start"]}


def test_encoder_units_are_the_librarys(nasty):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.TOKENIZER)
    t.encode_special_tokens = True
    rng = random.Random(8)
    bits = ["'re", " ", "  ", "\n", "\n ", "\t", "x", "12", "é", "\x1c", " ", "!", "<|endoftext|>", "word", "$$$", "&", "-", "Été", ".\nNext", "'s", "~'"]
    for text in [*("".join(rng.choices(bits, k=40)) for _ in range(300)), *(x for _, x in nasty if x)]:
        assert np.frombuffer(tokens.encoder()(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids


PAGES = [(1, "http://a/1", "<p>same</p>"), (2, "http://a/2", "<p>same</p>"), (3, None, "<p>same</p>"), (4, "http://a/4 x", None),
         (5, "u", ""), (6, "u", "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"),
         (7, "u", "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.1\r\nWARC-Type: resource\r\n"
                  "Content-Length: 99999\r\n\r\nend"),
         (8, "u", "ends\r\n"), (9, "u", "ends\r"), (10, "u", "ends\r\n\r\nWARC/1."), (11, "u", "é東\n" * 400), (None, "u", "<p>same</p>"),
         (12, "u", "\r\n\r\n" * 30), (13, "u", "\r\n\r\nWARC/1.1\r\n\r\nWARC/1.1\r\n")]


@pytest.mark.parametrize("block", ["128m", "97", "1000"])
def test_warc_round_trip_rejects_magic_in_payloads(spark, block):
    import base64

    pages = spark.createDataFrame(PAGES + [(100 + i, "u", f"page {i} " * (i % 40)) for i in range(80)] + [(14, "u", None)],
                                  "page_id long, url string, html string").withColumn("digest", F.lit("mine"))
    rows = pages.collect()
    most = defaultdict(list)
    for r in rows:
        most[r["html"] or ""].append(-1 if r["page_id"] is None else r["page_id"])
    want = set()
    for r in rows:
        body = (r["html"] or "").encode()
        top = max(most[r["html"] or ""])
        mine = -1 if r["page_id"] is None else r["page_id"]
        want.add((r["page_id"], len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(),
                  "response" if mine == top else "revisit", None if mine == top else top))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    with Scratch(spark, "t") as s:
        path = s.path("archives")
        warc.write_warc(pages.coalesce(2), path)
        spark.conf.set("spark.sql.files.maxPartitionBytes", block)
        try:
            rec = warc.read_warc(spark, path, s)
            found = s.keep(rec, "found")
            got = found.collect()
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        # with other blocks than the records were found in
        bodies = {(r["file"], r["offset"]): bytes(r["payload"]) for r in warc.read_payloads(spark, path, found, s).collect()}
        head = spark.read.text(path, wholetext=True).first()[0][:400]
    assert len(got) == len(rows)
    num = lambda x: int(x[10:-1]) if x and x[10:-1] else None
    assert {(num(r["record_id"]), r["payload_bytes"], r["digest_claimed"], r["record_type"], num(r["refers_to"])) for r in got} == want
    for r in got:           # also those with separators that go on in another block
        body = bodies[r["file"], r["offset"]]
        assert r["digest_read"] == base64.b32encode(hashlib.sha1(body).digest()).decode()
        if r["record_type"] == "response":
            assert r["digest_read"] == r["digest_claimed"] and len(body) == r["payload_bytes"]
        else:
            assert body == b""
    assert re.search(r"\r\nWARC-Date: \d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ\r\n", head)
