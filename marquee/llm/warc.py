"""WARC archives: writing with revisit records, reading by boundary chains.

**Writing** stays in the JVM: a record is one string column and the text
writer's line separator is the record terminator, so archives are ordinary
part files of any store Spark writes to, committed task by task.

**Reading** splits archives into byte blocks like any text. The separator is
the terminator plus ``WARC/1.``, so a unit never straddles two blocks and each
unit is a *candidate* record: a true one, or one whose magic stands in a
payload. A task turns its units into candidates with the offset of their
successor and follows successors inside its block (numpy pointer doubling).
Between blocks, pointer jumping from offset 0 of each file doubles the reach
in each round; candidates that no chain from a file's start reaches are
payload and are dropped. Per file there is one entry per block, so the rounds
move a few rows per block, never the records.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from base64 import b32encode

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.common import Scratch, table
from marquee.session import ship_package

# fixed values of the format
MAGIC = b"WARC/1."
END = b"\r\n\r\n"
SEPARATOR = END + MAGIC
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32HEX, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 SHA-1, built-in functions only (40 bits at a time)."""
    h = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(h, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.upper(F.concat(*parts)), BASE32HEX, BASE32)


def repeated_payloads(pages: DataFrame, key: str, payload: str) -> DataFrame:
    """(digest, response_id) of payloads that more than one row has; partial
    aggregation shrinks a payload that many rows share to one row a task."""
    p = pages.select(F.col(key).alias("id"), F.unhex(F.sha1(_bytes(payload))).alias("digest"))
    return (p.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("response_id"))
            .where("n > 1").drop("n"))


def _bytes(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit("")).cast("binary")


def write_warc(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html",
               min_revisit_bytes: int = 0, repeats: DataFrame | None = None, date: str | None = None) -> None:
    """One record per row: a response, or a revisit if another row with an equal
    payload of at least ``min_revisit_bytes`` bytes has a larger key.

    A null payload is empty; a null key is written as an empty id, smaller
    than all others; rows that agree in key and payload are all responses, or
    all revisits, like the one row they repeat. ``date`` names a timestamp column
    for ``WARC-Date``; without one, or where it is null, the time of writing
    stands there (UTC, whole seconds). Other columns are not read.
    ``repeats`` is ``repeated_payloads(...)`` if already stored: a stored table
    has a size, so Spark knows whether to send it to all tasks or to shuffle.
    """
    dup = repeated_payloads(pages, key, payload) if repeats is None else repeats
    p = pages.select(F.col(key).alias("id"), F.coalesce(F.col(url), F.lit("")).alias("url"),
                     F.coalesce(F.col(payload), F.lit("")).alias("body"),
                     F.coalesce(F.lit(None) if date is None else F.col(date).cast("timestamp"),
                                F.current_timestamp()).alias("date"))
    p = p.withColumn("digest", F.unhex(F.sha1(F.col("body").cast("binary"))))
    p = p.join(dup.withColumn("repeated", F.lit(True)), "digest", "left")
    size = F.octet_length("body")
    revisit = (F.coalesce("repeated", F.lit(False)) & (size >= min_revisit_bytes)
               & ~F.col("id").eqNullSafe(F.col("response_id")))
    crlf = "\r\n"
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    size.cast("string"), F.lit(crlf + crlf))
    block_bytes = F.octet_length(http) + F.when(revisit, 0).otherwise(size)
    name = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(">"))
    refers = F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("response_id").cast("string"),
                      F.lit(">\r\nWARC-Profile: " + REVISIT_PROFILE + crlf))
    clean_url = F.regexp_replace("url", r"[\x00-\x20]+", "%20")     # a header holds one line
    record = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), name,
        F.lit("\r\nWARC-Date: "),
        F.date_format(F.to_utc_timestamp("date", F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        F.lit("\r\nWARC-Target-URI: "), clean_url,
        F.lit("\r\nWARC-Payload-Digest: sha1:"), base32_sha1(F.col("body").cast("binary")), F.lit(crlf),
        F.when(revisit, refers).otherwise(""),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "), block_bytes.cast("string"),
        F.lit(crlf + crlf), http, F.when(revisit, "").otherwise(F.col("body")))
    p.select(record.alias("value")).write.option("lineSep", END.decode()).option("compression", "none").text(path)


# ------------------------------------------------------------------ reading

CANDIDATE = ("file string, block long, off long, next long, exit long, size long, record_type string, record_id string, "
             "target_uri string, refers_to string, digest_claimed string, payload_bytes long, digest_read string")


def _header(unit: bytes) -> tuple[int, dict[str, str]] | None:
    """(bytes of the header with its empty line, fields) of a candidate, whose
    unit begins after ``WARC/1.``; None if it is not a record header."""
    end = unit.find(END)
    lines = unit[: max(end, 0)].split(b"\r\n")
    if len(lines[0]) != 1 or not lines[0].isdigit():
        return None
    fields = {}
    for line in lines[1:]:
        k, colon, v = line.partition(b":")
        if not colon:
            return None
        fields[k.strip().lower().decode("latin-1")] = v.strip().decode("utf-8", "replace")
    if not fields.get("content-length", "").isdigit() or "warc-type" not in fields:
        return None
    return end + len(END), fields


class _Open:
    """A candidate whose block has been read up to ``have`` of ``want`` bytes."""

    def __init__(self, off: int, head: int, fields: dict[str, str]):
        self.off, self.fields = off, fields
        self.want = int(fields["content-length"])
        self.size = head + self.want
        self.have, self.http, self.sha, self.body = 0, b"", None, 0

    def feed(self, data: bytes) -> None:
        """Adds block bytes; the digest covers what follows the HTTP header."""
        data = data[: self.want - self.have]
        self.have += len(data)
        if self.sha is None:
            data, cut = self.http + data, 0
            if self.fields.get("content-type", "").startswith("application/http"):
                cut = data.find(END)
                if cut < 0 and self.have < self.want:
                    self.http = data
                    return
                cut = cut + len(END) if cut >= 0 else len(data)
            self.http, data, self.sha = data[:cut], data[cut:], hashlib.sha1()
        self.sha.update(data)
        self.body += len(data)

    def row(self) -> tuple:
        f = self.fields
        done = self.have == self.want
        sha = self.sha or hashlib.sha1()
        length = next((v for k, _, v in (x.partition(b":") for x in self.http.split(b"\r\n"))
                       if k.lower() == b"content-length"), b"").strip()
        size = int(length) if length.isdigit() and (f["warc-type"] == "revisit" or not done) else self.body
        return (f["warc-type"], f.get("warc-record-id"), f.get("warc-target-uri"), f.get("warc-refers-to"),
                f.get("warc-payload-digest", "").removeprefix("sha1:") or None, size,
                b32encode(sha.digest()).decode() if done else None)


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bytes]]:
    for b in batches:
        for file, block, value in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
            for part in value.split(SEPARATOR):      # the reader can miss one at a buffer's edge
                yield file, block, part


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates of each block, offsets counted from the block's first unit;
    one summary row (off -1) holds the bytes that the block's units take."""
    schema = _schema()
    state: dict = {"at": None}
    rows: list[tuple] = []

    def close(at, cands, pos):
        n = len(cands)
        if n:
            offs = np.array([c.off for c in cands], dtype=np.int64)
            nxt = np.array([c.off + c.size + len(END) for c in cands], dtype=np.int64)
            # pointer doubling: a successor inside the block must be a candidate (n: it is not)
            i = np.searchsorted(offs, nxt)
            inside, hit = nxt < pos - len(MAGIC), offs[np.minimum(i, n - 1)] == nxt
            jump = np.append(np.where(inside, np.where(hit, i, n), np.arange(n)), n)
            for _ in range(n.bit_length()):
                jump = jump[jump]
            exits = np.where(jump[:n] < n, nxt[np.minimum(jump[:n], n - 1)], -1)
            rows.extend((*at, o, e, x, c.size, *c.row())
                        for c, o, e, x in zip(cands, offs.tolist(), nxt.tolist(), exits.tolist()))
        rows.append((*at, -1, pos, -1, 0, None, None, None, None, None, 0, None))

    def flush():
        cols = list(zip(*rows))
        rows.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(cols, schema)], schema=schema)

    for file, block, unit in _units(batches):
        if state["at"] != (file, block):
            if state["at"] is not None:
                close(state["at"], state["done"], state["pos"])
                if len(rows) > 5000:
                    yield flush()
            state = {"at": (file, block), "done": [], "live": [], "pos": 0}
        pos = state["pos"]
        start = pos - len(MAGIC)                         # the candidate's magic begins here
        if block == 0 and pos == 0:
            if unit.startswith(MAGIC):
                unit, start = unit[len(MAGIC):], 0
                state["pos"] = len(MAGIC)
        for c in state["live"]:
            c.feed(SEPARATOR + unit)
        state["live"] = [c for c in state["live"] if c.have < c.want]
        got = _header(unit)
        if got:
            c = _Open(start, len(MAGIC) + got[0], got[1])
            c.feed(unit[got[0]:])
            state["done"].append(c)
            if c.have < c.want:
                state["live"].append(c)
        state["pos"] += len(unit) + len(SEPARATOR)
    if state["at"] is not None:
        close(state["at"], state["done"], state["pos"])
    if rows:
        yield flush()


def _schema() -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64()}
    return pa.schema([(n, kinds[t]) for n, t in (x.split(" ") for x in CANDIDATE.split(", "))])


def _walk(key, rows):
    """Records of one block: the chain from its entry."""
    rows = rows.sort_values("abs", ignore_index=True)
    offs, nxt = rows["abs"].to_numpy(), rows["abs_next"].to_numpy()
    at, keep = int(rows["entry"].iloc[0]), []
    while True:
        i = int(np.searchsorted(offs, at))
        if i >= len(offs) or offs[i] != at:
            break
        keep.append(i)
        at = int(nxt[i])
    return rows.iloc[keep].drop(columns=["entry"])


def _unit_lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.option("lineSep", SEPARATOR.decode()).text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                        F.col("value").cast("binary").alias("value"))


def _block_bases(sums: DataFrame) -> DataFrame:
    """file, block, taken (bytes) with the offset at which each block's units begin."""
    w = _running("file", "block")
    return (sums.withColumn("base", F.coalesce(F.sum("taken").over(w), F.lit(0)))
            .withColumn("end", F.col("base") + F.col("taken")))


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Units with their offset, counted from the block's first, and what they take."""
    at, pos = None, 0
    for b in batches:
        rows = []
        for file, block, unit in _units(iter([b])):
            if at != (file, block):
                at, pos = (file, block), 0
            if block == 0 and pos == 0 and unit.startswith(MAGIC):
                unit, pos = unit[len(MAGIC):], len(MAGIC)
            rows.append((file, block, pos, pos + len(unit) + len(SEPARATOR), unit))
            pos += len(unit) + len(SEPARATOR)
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                names=["file", "block", "off", "stop", "unit"])


def _joined(key, rows):
    """The payload of one record from its units, in order."""
    units = rows.sort_by("abs").column("unit").to_pylist()
    head, fields = _header(units[0])
    body = SEPARATOR.join([units[0][head:], *units[1:]])[: int(fields["content-length"])]
    if fields.get("content-type", "").startswith("application/http"):
        cut = body.find(END)
        body = body[cut + len(END):] if cut >= 0 else b""
    return pa.table({"file": [key[0].as_py()], "offset": [key[1].as_py()], "payload": pa.array([body], pa.binary())})


def read_payloads(spark: SparkSession, path: str, records: DataFrame, scratch: Scratch) -> DataFrame:
    """file, offset, payload (binary, without the HTTP header) of ``records``,
    rows of ``read_warc`` over the same ``path``; a revisit's is empty.

    A record is joined with the unit it begins with. Only a record that goes
    beyond that unit, because its payload holds separators, also takes those
    whose separator begins before its end, in whatever blocks they lie. One payload is put together in one
    task; a record cut short gives what is there."""
    ship_package(spark)
    placed = _unit_lines(spark, path).mapInArrow(_placed, "file string, block long, off long, stop long, unit binary")
    placed = scratch.keep(placed, "units")
    base = scratch.keep(_block_bases(placed.groupBy("file", "block").agg(F.max("stop").alias("taken"))), "unit_blocks")
    units = placed.join(base.select("file", "block", "base"), ["file", "block"]).select(
        "file", (F.col("off") + F.col("base")).alias("abs"), "unit")
    todo = records.select("file", "offset", "size")
    first = todo.withColumn("abs", F.col("offset") + len(MAGIC)).join(units, ["file", "abs"])
    more = scratch.keep(first.where(F.octet_length("unit") + len(MAGIC) < F.col("size"))
                        .select("file", "offset", "size"), "long_records")
    u = units.withColumnRenamed("file", "unit_file")
    parts = more.join(u, (F.col("file") == F.col("unit_file")) & (F.col("abs") > F.col("offset") + len(MAGIC))
                      & (F.col("abs") < F.col("offset") + F.col("size") + len(SEPARATOR))).select("file", "offset", "abs", "unit")
    schema = "file string, offset long, payload binary"
    return first.select("file", "offset", "abs", "unit").unionByName(parts).groupBy("file", "offset").applyInArrow(_joined, schema)


def read_warc(spark: SparkSession, path: str, scratch: Scratch) -> DataFrame:
    """Records of the archives under ``path`` that the chain from each file's
    start reaches: file, offset, size (of the record), record_type, record_id,
    target_uri, refers_to, digest_claimed, payload_bytes (of the full payload),
    digest_read (of the payload bytes in the archive). ``read_payloads`` gives
    the payloads; it is also used for the digests of payloads that hold record
    separators and go on in another block. A file cut short ends its chain at
    the last whole record. Empty files give no rows."""
    ship_package(spark)
    cand = scratch.keep(_unit_lines(spark, path).mapInArrow(_candidates, CANDIDATE), "candidates")
    # absolute offsets: what the blocks before took
    sums = cand.where("off = -1").select("file", "block", F.col("next").alias("taken"))
    base = scratch.keep(_block_bases(sums), "blocks")
    c = cand.where("size > 0").join(base, ["file", "block"]).withColumns({
        "abs": F.col("off") + F.col("base"), "abs_next": F.col("next") + F.col("base"),
        "abs_exit": F.when(F.col("exit") >= 0, F.col("exit") + F.col("base"))})
    c = scratch.keep(c.drop("off", "next", "exit", "taken", "base", "end"), "records")
    # entries of blocks: the file's start and whatever some chain leaves its block for
    targets = (c.where("abs_exit is not null").select("file", F.col("abs_exit").alias("abs"))
               .unionByName(c.select("file").distinct().withColumn("abs", F.lit(0).cast("long"))).distinct())
    jump = scratch.keep(targets.join(c.select("file", "abs", F.col("abs_exit").alias("to")), ["file", "abs"]), "jump")
    reach = jump.where("abs = 0").select("file", "abs")
    reached = reach.count()
    while True:
        step = reach.join(jump, ["file", "abs"]).select("file", F.col("to").alias("abs")).where("abs is not null")
        reach = scratch.keep(reach.unionByName(step.join(jump.select("file", "abs"), ["file", "abs"], "left_semi"))
                             .distinct(), "reach")
        n = reach.count()
        if n == reached:
            break
        reached = n
        far = jump.select("file", F.col("abs").alias("to"), F.col("to").alias("far"))
        jump = scratch.keep(jump.join(far, ["file", "to"], "left").select("file", "abs", F.col("far").alias("to")), "jump")
    entry = reach.join(c.select("file", "block", "abs"), ["file", "abs"]).select("file", "block", F.col("abs").alias("entry"))
    c = c.drop("abs_exit")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in c.schema)
    good = c.join(entry, ["file", "block"]).groupBy("file", "block").applyInPandas(_walk, schema)
    good = scratch.keep(good.select("file", F.col("abs").alias("offset"), "size", "record_type", "record_id", "target_uri",
                                    "refers_to", "digest_claimed", "payload_bytes", "digest_read"), "reached")
    parted = good.where("digest_read is null")
    if parted.isEmpty():
        return good
    late = read_payloads(spark, path, parted, scratch).select(
        "file", "offset", base32_sha1(F.col("payload")).alias("late_digest"), F.octet_length("payload").alias("late_bytes"))
    late = scratch.keep(late, "late")
    revisit = F.col("record_type") == "revisit"         # states the length of the payload it does not hold
    return (good.join(late, ["file", "offset"], "left")
            .withColumn("payload_bytes", F.when(revisit, F.col("payload_bytes"))
                        .otherwise(F.coalesce(F.col("late_bytes").cast("long"), "payload_bytes")))
            .withColumn("digest_read", F.coalesce("digest_read", "late_digest")).drop("late_digest", "late_bytes"))


def _running(part: str, order: str):
    from pyspark.sql import Window

    return Window.partitionBy(part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def q_op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a record and read back from the archives."""
    pages = table(spark, sf_dir, "pages")
    with Scratch(spark, "op1") as s:
        path = s.path("archives")
        dup = s.keep(repeated_payloads(pages, "page_id", "html"), "repeats")
        write_warc(pages, path, repeats=dup)
        page = lambda c: F.regexp_extract(c, r"^<urn:page:(.*)>$", 1).try_cast("bigint")
        rec = read_warc(spark, path, s)
        out = rec.select(
            page("record_id").alias("page_id"),
            "payload_bytes", "record_type",
            F.when(F.col("record_type") == "revisit", F.col("digest_claimed"))
            .otherwise(F.col("digest_read")).alias("payload_digest"),
            F.when(F.col("record_type") == "revisit", page("refers_to")).alias("refers_to"))
        return s.keep(out, result=True)
