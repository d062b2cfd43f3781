"""WARC archives: distributed writing with revisit records, and reading by boundary-chain verification.

Writing. One record per page. Of pages with an equal payload of at least ``least_bytes`` bytes, the smallest page_id is
written as a response and the others as revisits that refer to it. Spark's text writer writes the records of a task one
after another, with the end of a record as its line separator, so the files are plain WARC.

Reading. The archives are read as lines that end at the record magic, so that tasks take splits of a file, not whole
files, and a magic inside a payload only makes one more candidate.

1. Each task emits its candidates: offset in its split, and the record's successor by its Content-Length.
2. The candidates of a split are followed to where they leave it; the splits' places are a prefix sum over their sizes.
3. Pointer jumping from the start of every file over these exits (two joins a round, doubling the distance) leaves the
   places that the chain reaches. Candidates off the chain are payload.
4. Records that are one piece are complete already. Those whose payload holds a magic are put together again from their
   pieces, which a second scan fetches; nothing else is moved.

Defined cases: pages without a page_id are left out; a null payload is empty; a null URL writes no header; line breaks in
a URL are written as %0D and %0A; rows that repeat a page_id are a record each, responses if that id is the smallest; an
empty table writes no record; further columns are ignored. A payload of any length is one record, written and read whole by one
task. A chain that breaks (a damaged file) ends there.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textforge._ship import by_value
from textforge.session import materialize

by_value(__name__)

MAGIC = b"WARC/1.0\r\n"
END = b"\r\n\r\n"
FILE = ["file", "block"]


# ---------------------------------------------------------------- writing
def write_warc(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html",
               least_bytes: int = 100, date: str = "2026-01-01T00:00:00Z") -> None:
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), body.alias("body")).filter("page_id is not null")
    rows = rows.withColumns({"n": F.octet_length("body"), "digest": F.sha2("body", 256)})
    # one row per payload that occurs again; written first, so its size is known when the join is planned
    groups = rows.filter(F.col("n") >= least_bytes).groupBy("digest").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last"))
    groups = materialize(groups.filter("first < last").select("digest", "first"), "warc-equal")
    rows = rows.join(groups, "digest", "left")
    revisit = F.coalesce(F.col("page_id") != F.col("first"), F.lit(False))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n").cast("string"), F.lit("\r\n\r\n"))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.col(c).cast("string"), F.lit(">"))
    header = F.concat_ws(
        "\r\n", F.lit("WARC/1.0"), F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), name("page_id")), F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), name("first"))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), (F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("n"))).cast("string")))
    record = F.concat(header.cast("binary"), F.lit(END), http.cast("binary"), F.when(revisit, F.lit(b"")).otherwise(F.col("body")))
    rows.select(record.cast("string").alias("value")).write.option("lineSep", END.decode()).text(path)


# ---------------------------------------------------------------- reading
def parse_block(block: bytes) -> tuple[bytes, int]:
    """Payload of an HTTP response block, and its length as the HTTP header has it."""
    head, sep, body = block.partition(END)
    m = re.search(rb"(?im)^content-length:[ \t]*(\d+)", head)
    return (body, int(m[1]) if m else len(body)) if sep else (block, len(block))


def parse_piece(piece: bytes) -> tuple[int, str | None, bytes | None]:
    """(bytes from the magic to the successor or -1, header, block if it is complete) of what follows a magic."""
    at = piece.find(END)
    m = re.search(rb"(?im)^content-length:[ \t]*(\d+)[ \t]*\r?$", piece[: at + 2]) if at >= 0 else None
    if not m:
        return -1, None, None
    size = at + len(END) + int(m[1])
    block = piece[at + len(END) : size] if len(piece) == size + len(END) and piece.endswith(END) else None
    return len(MAGIC) + size + len(END), piece[:at].decode("utf-8", "replace"), block


def raw_pieces(spark: SparkSession, path: str) -> DataFrame:
    """file, block, value of every piece between magics, in order inside a split."""
    lines = spark.read.option("lineSep", MAGIC.decode()).text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value"))


def located(batches):
    """(file, block, offset in the split, piece): a running sum over the pieces of a split."""
    at, now = 0, None
    for batch in batches:
        values = batch.column("value")
        for i, where in enumerate(zip(batch.column("file").to_pylist(), batch.column("block").to_pylist())):
            if where != now:
                at, now = 0, where
            piece = values[i].as_py()
            yield *where, at, piece
            at += len(piece) + len(MAGIC)


def emit(rows, names, kinds, most_bytes=8_000_000):
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 200 + sum(len(x) for x in row if isinstance(x, bytes))
        if size > most_bytes:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)


def candidates(spark: SparkSession, path: str, with_payload: bool) -> DataFrame:
    """Every piece: file, block, at (offset in the split), size, step (to the successor, -1: none), header, and of a
    complete record n, digest (and payload)."""

    def run(batches):
        def rows():
            for file, block, at, piece in located(batches):
                if block == 0 and at == 0:  # before the first magic of a file
                    yield file, block, at, len(piece), -1, None, None, None, None, None
                    continue
                step, header, whole = parse_piece(piece)
                body, length = parse_block(whole) if whole is not None else (None, None)
                yield file, block, at, len(piece), step, header, length, len(body) if body is not None else None, hashlib.sha256(body).hexdigest() if body is not None else None, body if with_payload else None

        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        yield from emit(rows(), ["file", "block", "at", "size", "step", "header", "length", "n", "digest", "payload"], kinds)

    return raw_pieces(spark, path).mapInArrow(run, "file string, block long, at long, size long, step long, header string, length long, n long, digest string, payload binary")


def exits(part: pd.DataFrame) -> pd.DataFrame:
    """Of a split: its bytes, and where each candidate's chain leaves it (offsets in the split)."""
    part = part.sort_values("at", kind="stable")
    magic = len(MAGIC)
    at, step = part["at"].to_numpy() - magic, part["step"].to_numpy()
    leaves: dict[int, int] = {}
    for c, s in zip(at[::-1].tolist(), step[::-1].tolist()):
        if s > 0:
            leaves[c] = leaves.get(c + s, c + s)
    total = int(part["size"].sum()) + magic * len(part)
    return pd.DataFrame({"file": part["file"].iloc[:1], "block": part["block"].iloc[:1], "total": [total], "c": [list(leaves)], "x": [list(leaves.values())]})


def owners(part: pd.DataFrame) -> pd.DataFrame:
    """Of a split whose entry is known: each piece's place in the file, whether it is a record, and its record's end."""
    part = part.sort_values("at", kind="stable")
    base, entry = int(part["base"].iloc[0]), part["entry"].iloc[0]
    off = base + part["at"].to_numpy() - len(MAGIC)
    nxt = int(entry) if not pd.isna(entry) else -1
    end = int(part["end_key"].iloc[0]) if not pd.isna(part["end_key"].iloc[0]) else -1
    record, ends = np.zeros(len(part), bool), np.zeros(len(part), np.int64)
    for i, (o, s) in enumerate(zip(off.tolist(), part["step"].tolist())):
        if o == nxt and s > 0:
            record[i], nxt = True, o + s
            end = nxt
        ends[i] = end
    return pd.DataFrame({"file": part["file"], "block": part["block"], "at": part["at"], "off": off, "record": record, "end": ends})


def reached(jumps: DataFrame) -> DataFrame:
    """(file, off) of all places on the chains that start at offset 0, by pointer jumping."""
    reach = jumps.select("file", F.lit(0).cast("long").alias("off")).distinct()
    while True:
        step = jumps.select("file", "off", "nxt")
        reach = materialize(reach.union(reach.join(step, ["file", "off"]).select("file", F.col("nxt").alias("off"))).distinct(), "warc-reach")
        far = step.join(step.select("file", F.col("off").alias("nxt"), F.col("nxt").alias("then")), ["file", "nxt"])
        jumps = materialize(far.select("file", "off", F.col("then").alias("nxt")), "warc-jumps")
        if jumps.isEmpty():
            return reach


def read_warc(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """file, off, header, length (as the HTTP header has it), n (payload bytes here), digest of them (and payload)."""
    pieces = materialize(candidates(spark, path, with_payload), "warc-pieces")
    light = pieces.select("file", "block", "at", "size", "step")
    splits = materialize(light.groupBy(*FILE).applyInPandas(exits, "file string, block long, total long, c array<long>, x array<long>"), "warc-splits")
    order = W.partitionBy("file").orderBy("block")  # a row for each split
    places = splits.withColumn("base", F.coalesce(F.sum("total").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    jumps = places.select("file", "block", "base", F.explode(F.arrays_zip("c", "x")).alias("j")).select(
        "file", "block", (F.col("base") + F.col("j.c")).alias("off"), (F.col("base") + F.col("j.x")).alias("nxt"))
    jumps = materialize(jumps, "warc-exits")
    reach = reached(jumps)
    entry = reach.join(jumps, ["file", "off"]).groupBy(*FILE).agg(F.min("off").alias("entry"))
    # the first reached place at or after a split's start ends the record that covers the split's first pieces
    marks = places.select("file", F.col("base").alias("p"), "block", F.lit(None).cast("long").alias("off")).union(
        reach.select("file", F.col("off").alias("p"), F.lit(None).cast("long"), "off"))
    later = W.partitionBy("file").orderBy("p", F.col("off").isNotNull()).rowsBetween(0, W.unboundedFollowing)
    marks = marks.withColumn("end_key", F.min("off").over(later)).filter("block is not null").select("file", "block", F.col("p").alias("base"), "end_key")
    meta = materialize(marks.join(entry, FILE, "left"), "warc-entries")
    owned = light.join(meta, FILE).groupBy(*FILE).applyInPandas(owners, "file string, block long, at long, off long, record boolean, end long")
    owned = materialize(owned, "warc-owners")
    records = pieces.join(owned.filter("record"), ["file", "block", "at"])
    whole = records.filter("digest is not null").select("file", "off", "header", "length", "n", "digest", "payload")
    parts = records.filter("digest is null").select("file", "end", "header", F.col("off").alias("start"))
    if not parts.isEmpty():
        parts = materialize(parts, "warc-parts")
        wanted = owned.join(parts.select("file", "end", "start"), ["file", "end"]).filter("off >= start").select("file", "block", "at", "end", "off")

        def fetch(batches):
            yield from emit(located(batches), ["file", "block", "at", "piece"], [pa.string(), pa.int64(), pa.int64(), pa.binary()])

        bytes_of = raw_pieces(spark, path).mapInArrow(fetch, "file string, block long, at long, piece binary").join(wanted, ["file", "block", "at"])
        joined = bytes_of.groupBy("file", "end").agg(F.sort_array(F.collect_list(F.struct("off", "piece"))).alias("pieces")).join(parts, ["file", "end"])

        def build(batches):
            def rows():
                for batch in batches:
                    for r in batch.to_pylist():
                        _, _, block = parse_piece(MAGIC.join(x["piece"] for x in r["pieces"]))
                        if block is not None:  # else the archive is damaged here
                            body, length = parse_block(block)
                            yield r["file"], r["start"], r["header"], length, len(body), hashlib.sha256(body).hexdigest(), body if with_payload else None

            yield from emit(rows(), ["file", "off", "header", "length", "n", "digest", "payload"], [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()])

        whole = whole.union(joined.mapInArrow(build, "file string, off long, header string, length long, n long, digest string, payload binary"))
    return whole if with_payload else whole.drop("payload")


def records(read: DataFrame) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to (and payload) from the headers and payloads."""
    field = lambda name, pattern: F.nullif(F.regexp_extract("header", rf"(?m)^{name}: {pattern}\r?$", 1), F.lit(""))
    kind = field("WARC-Type", "(.*?)")
    revisit = kind == "revisit"
    return read.select(
        field("WARC-Record-ID", "<urn:page:(-?[0-9]+)>").cast("long").alias("page_id"),
        field("WARC-Target-URI", "(.*?)").alias("url"),
        F.when(revisit, F.col("length")).otherwise(F.col("n")).alias("payload_bytes"),
        F.when(revisit, field("WARC-Payload-Digest", "sha256:([0-9a-f]+)")).otherwise(F.col("digest")).alias("payload_digest"),
        kind.alias("record_type"),
        field("WARC-Refers-To", "<urn:page:(-?[0-9]+)>").cast("long").alias("refers_to"),
        *[c for c in ("payload",) if c in read.columns])
