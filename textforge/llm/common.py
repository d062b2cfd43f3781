"""Shared helpers of the training-data operators: words, hashes, exchange of packed arrays, shared files.

Words on white space are bytes of the UTF-8 text split at ``\\x20\\x09-\\x0D`` (``bytes.split()`` does exactly this);
``bytes.lower()`` lower-cases A-Z only. All hashes are unsigned 64-bit.
"""

from __future__ import annotations

import os
import re
import sys
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textforge._ship import by_value
from textforge.session import scratch_path

by_value(__name__)

MULT = 0x9E3779B97F4A7C15  # odd multiplier of the rolling hashes
INV = pow(MULT, -1, 1 << 64)
ALNUM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


# ---------------------------------------------------------------- inputs
def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Only the two columns an operator reads, under fixed names, and those to ``keep`` as ``keep_*``; clashing extra
    columns disappear here."""
    kept = [F.col(c).alias(f"keep_{c}") for c in keep or []]
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *kept)


def with_kept(schema: str, rows: DataFrame) -> T.StructType:
    """Output schema of a task function that hands the ``keep_*`` columns of its input on."""
    out = T.StructType.fromDDL(schema)
    return T.StructType(out.fields + [f for f in rows.schema.fields if f.name.startswith("keep_")])


def kept_slices(batch: pa.RecordBatch, at: int, n: int) -> tuple[list, list[str]]:
    """The ``keep_*`` columns of ``n`` rows of a batch, from row ``at`` on."""
    names = [c for c in batch.schema.names if c.startswith("keep_")]
    return [batch.column(c).slice(at, n) for c in names], names


def unkept(df: DataFrame) -> DataFrame:
    """``keep_*`` columns under their own names again."""
    return df.select(*[F.col(c).alias(c.removeprefix("keep_")) for c in df.columns])


MOST_BROADCAST_ROWS = 1_000_000


def small_side(df: DataFrame, rows: int, most: int = MOST_BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint for a side of ``rows`` counted small rows, if these are at most ``most``; a shuffle join beyond."""
    return F.broadcast(df) if rows <= most else df


# ---------------------------------------------------------------- hashing
def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser (bijective), so that every bit of a rolling sum reaches the high bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def word_hashes(words: list[bytes], seed: int = 0) -> np.ndarray:
    if seed:
        return np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in words), np.uint64, len(words))
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


_POW: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for the next call."""
    have = _POW.get(base)
    if have is None or len(have) < n:
        size = max(1024, 1 << (max(n, 1) - 1).bit_length())
        p = np.full(size, base, np.uint64)
        p[0] = 1
        _POW[base] = have = np.multiply.accumulate(p)
    return have[:n]


def rolling(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive values (len(h) - k + 1 of them), position independent."""
    n = len(h)
    if n < k or k < 1:
        return np.zeros(0, np.uint64)
    s = np.zeros(n + 1, np.uint64)
    np.cumsum(h * powers(MULT, n), out=s[1:])
    return mix((s[k:] - s[:-k]) * powers(INV, n - k + 1))


def window_min(v: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive values, by doubling."""
    out, have = v, 1
    while have < w:
        step = min(have, w - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


# ---------------------------------------------------------------- shared files
def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's shared ``spark.checkpoint.dir`` that workers open as files.

    Memory-mapped arrays need a mounted path; another kind of store is refused here, not half way.
    """
    path = scratch_path(spark, name)
    scheme, sep, rest = path.partition("://")
    if not sep:
        path = path[5:] if path.startswith("file:/") else path
    elif scheme == "file":
        path = "/" + rest.lstrip("/")
    else:
        raise ValueError(f"spark.checkpoint.dir must be a mounted shared folder for memory-mapped arrays, not {path}")
    os.makedirs(path, exist_ok=True)
    return path


def save_array(folder: str, name: str, values: np.ndarray) -> str:
    """Write once under the final name: a repeated or speculative task replaces the file by an equal one."""
    path = f"{folder}/{name}.npy"
    part = f"{folder}/.{name}-{uuid.uuid4().hex}"
    with open(part, "wb") as out:
        np.save(out, values)
    os.replace(part, path)
    return path


def load_array(folder: str, name: str) -> np.ndarray:
    return np.load(f"{folder}/{name}.npy", mmap_mode="r")


class Files(dict):
    """Memory-mapped arrays ``name-bucket`` of a folder, opened when they are first asked for."""

    def __init__(self, folder: str, name: str):
        super().__init__()
        self.folder, self.name = folder, name

    def __missing__(self, bucket: int) -> np.ndarray:
        self[bucket] = found = load_array(self.folder, f"{self.name}-{bucket}")
        return found


# ---------------------------------------------------------------- packed exchange
# Numbers by the million travel as one binary row for each batch and bucket, not as a row each.
PACKED = "bucket int, payload binary"


def pack_arrays(*arrays: np.ndarray) -> bytes:
    """Columns of integers as bytes: each one's minimum, then the differences in the smallest type that holds them."""
    out = []
    for x in arrays:
        x = np.ascontiguousarray(x)
        low = x.min() if len(x) else x.dtype.type(0)
        over = (x - low).view(f"u{x.dtype.itemsize}") if x.dtype.kind == "i" else x - low
        kind = np.min_scalar_type(int(over.max()) if len(x) else 0)
        out += [np.array([len(x)], "<u8").tobytes(), bytes([kind.itemsize]), np.array([low]).astype("<i8" if x.dtype.kind == "i" else "<u8").tobytes(), over.astype(kind).tobytes()]
    return b"".join(out)


def unpack_arrays(payload: bytes, columns: int) -> list[np.ndarray]:
    """The columns as unsigned 64-bit numbers (``.view(np.int64)`` gives signed ones back)."""
    at, out = 0, []
    for _ in range(columns):
        n, size = int.from_bytes(payload[at : at + 8], "little"), payload[at + 8]
        low = np.frombuffer(payload, "<u8", 1, at + 9)
        out.append(np.frombuffer(payload, f"<u{size}", n, at + 17).astype(np.uint64) + low)
        at += 17 + size * n
    return out


def arrays_of(table: pa.Table, columns: int) -> list[list[np.ndarray]]:
    """The payloads' columns, each as a list of one array for each payload."""
    return list(zip(*[unpack_arrays(x.as_py(), columns) for x in table.column("payload")])) or [[]] * columns


def edges_of(sorted_hashes: np.ndarray, bits: int) -> np.ndarray:
    """Where each bucket (leading bits) begins, and the end."""
    if not bits:
        return np.array([0, len(sorted_hashes)])
    cuts = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.concatenate([[0], np.searchsorted(sorted_hashes, cuts), [len(sorted_hashes)]])


def packed_batch(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    b, p = zip(*rows) if rows else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(b, pa.int32()), pa.array(p, pa.binary())], names=["bucket", "payload"])


def bucket_bits(amount: float, per_bucket: float, least: int = 5) -> int:
    """log2 of a number of buckets of about ``per_bucket`` each."""
    return max(least, int(np.ceil(np.log2(max(1.0, amount / per_bucket)))))


def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of each one's counts."""
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    return totals(k[order], c[order])


def totals(k: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of sorted ones, and the sum of each one's counts."""
    starts = np.flatnonzero(np.append(True, k[1:] != k[:-1])) if len(k) else np.zeros(0, np.int64)
    return k[starts], np.add.reduceat(c, starts, dtype=np.uint64) if len(k) else c


class SortedFiles:
    """Memory-mapped arrays of a folder: sorted hashes by bucket, and columns beside them."""

    def __init__(self, folder: str, name: str, bits: int, present: list[int], columns: list[str]):
        self.bits, self.present = bits, np.array(sorted(present), np.int64)
        self.keys = Files(folder, name)
        self.columns = {c: Files(folder, c) for c in columns}

    def find(self, hashes: np.ndarray, second: np.ndarray | None = None, check: str | None = None) -> dict[str, np.ndarray]:
        """``found`` and the columns' values (0 if not found) for hashes in any order.

        With ``check``, equal hashes stand next to each other and the one whose column ``check`` has ``second`` counts."""
        order = np.argsort(hashes, kind="stable")
        h = hashes[order]
        found = np.zeros(len(h), bool)
        out: dict[str, np.ndarray] = {}
        edges = edges_of(h, self.bits)
        for b in self.present[edges[self.present] < edges[self.present + 1]].tolist():  # those that hashes fall into
            x, y, keys = edges[b], edges[b + 1], self.keys[b]
            for c, values in self.columns.items():
                if c not in out:
                    out[c] = np.zeros(len(h), values[b].dtype)
            at = np.searchsorted(keys, h[x:y])
            rest = np.arange(x, y)
            while len(rest):
                ok = at < len(keys)
                at, rest = at[ok], rest[ok]
                ok = keys[at] == h[rest]
                at, rest = at[ok], rest[ok]
                hit = self.columns[check][b][at] == second[order[rest]] if check else np.ones(len(at), bool)
                found[rest[hit]] = True
                for c, values in self.columns.items():
                    out[c][rest[hit]] = values[b][at[hit]]
                at, rest = at[~hit] + 1, rest[~hit]
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        return {"found": found[back], **{c: out[c][back] if c in out else np.zeros(len(h), np.int64) for c in self.columns}}


# ---------------------------------------------------------------- worker memory
SLOT = "_textforge_worker_table"


def worker_table(key, make):
    """A table that outlives a task in its worker process, one at a time: another operator's table is let go."""
    have = sys.__dict__.get(SLOT)
    if have is None or have[0] != key:
        sys.__dict__.pop(SLOT, None)
        have = sys.__dict__[SLOT] = (key, make())
    return have[1]


def let_go() -> None:
    """Frees the table that an earlier operator left in this worker."""
    sys.__dict__.pop(SLOT, None)


# ---------------------------------------------------------------- merged sketches
class Sketch:
    """A count-min sketch of hashes, merged over all tasks and memory-mapped; counters saturate at two.

    Its width follows the number of hashes, so that its share of false "twice" stays the same at every size. Each task
    sends, for each bucket of a row's cells, the cells it has counted; a bucket's task adds them up and writes one bit for
    each cell that was counted twice or more. ``repeated`` takes the minimum over the rows: it may say "twice" of a hash
    that occurred once, never "once" of one that occurred twice.
    """

    def __init__(self, folder: str, cell_bits: int, bits: int, rows: int):
        self.folder, self.cell_bits, self.bits, self.rows = folder, cell_bits, bits, rows

    @staticmethod
    def sized(folder: str, hashes: float, rows: int, per_bucket: float = 4_000_000) -> Sketch:
        cell_bits = max(16, int(np.ceil(np.log2(max(1.0, 4 * hashes)))))
        return Sketch(folder, cell_bits, min(bucket_bits(hashes, per_bucket), cell_bits - 8), rows)

    def cells(self, hashes: np.ndarray, row: int) -> np.ndarray:
        return (mix(hashes + np.uint64(row) * np.uint64(MULT)) if row else hashes) >> np.uint64(64 - self.cell_bits)

    def counted(self, hashes: np.ndarray, counts: np.ndarray | None = None) -> list[tuple[int, bytes]]:
        """Payloads by bucket of the cells of distinct hashes (``counts``: how often each occurred, else once)."""
        out = []
        for row in range(self.rows):
            cells = np.sort(self.cells(hashes, row)) if counts is None else np.sort(np.repeat(self.cells(hashes, row), np.minimum(counts, 2)))
            low = np.uint64(self.cell_bits - self.bits)
            edges = np.searchsorted(cells, np.arange((1 << self.bits) + 1, dtype=np.uint64) << low)
            for b, (x, y) in enumerate(zip(edges, edges[1:])):
                if y > x:
                    out.append((row << self.bits | b, pack_arrays(cells[x : x + 1] - (np.uint64(b) << low), np.diff(cells[x:y]))))
        return out

    def merge(self, table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        seen = np.zeros(1 << (self.cell_bits - self.bits), np.uint8)
        for x in table.column("payload"):
            first, steps = unpack_arrays(x.as_py(), 2)
            cells, n = np.unique(np.cumsum(np.concatenate([first, steps])), return_counts=True)
            seen[cells] = np.minimum(seen[cells] + np.minimum(n, 2), 2)
        save_array(self.folder, f"sketch-{bucket}", np.packbits(seen > 1))
        return pa.table({"bucket": pa.array([bucket], pa.int32())})

    def build(self, packed_rows: DataFrame) -> list[int]:
        """Merges the rows made by ``counted``; the buckets that have a file."""
        def merge(table: pa.Table) -> pa.Table:
            return self.merge(table)

        return sorted(r.bucket for r in packed_rows.groupBy("bucket").applyInArrow(merge, "bucket int").collect())

    def open(self, present: list[int]) -> tuple[Files, set[int]]:
        return Files(self.folder, "sketch"), set(present)

    def repeated(self, opened: tuple[Files, set[int]], hashes: np.ndarray) -> np.ndarray:
        files, present = opened
        out = np.ones(len(hashes), bool)
        low = np.uint64(self.cell_bits - self.bits)
        for row in range(self.rows):
            left = np.flatnonzero(out)
            cells = self.cells(hashes[left], row)
            order = np.argsort(cells, kind="stable")
            cells = cells[order]
            edges = np.searchsorted(cells, np.arange((1 << self.bits) + 1, dtype=np.uint64) << low)
            for b, (x, y) in enumerate(zip(edges, edges[1:])):
                if y > x:
                    c = cells[x:y] - (np.uint64(b) << low)
                    bits = files[row << self.bits | b] if row << self.bits | b in present else None
                    hit = np.zeros(y - x, bool) if bits is None else ((bits[(c >> np.uint64(3)).astype(np.int64)] >> (7 - (c & np.uint64(7))).astype(np.uint8)) & 1).astype(bool)
                    out[left[order[x:y]]] = hit
        return out


def word_batches(batches, most_words: int = 2_000_000):
    """Lists of (doc_id, bytes) that hold about ``most_words`` words together (or one long text)."""
    let_go()
    held, size = [], 0
    for doc, text in text_rows(batches):
        held.append((doc, text or b""))
        size += len(held[-1][1])
        if size >= 6 * most_words:
            yield held
            held, size = [], 0
    if held:
        yield held


# ---------------------------------------------------------------- inputs in tasks
def text_rows(batches):
    """(doc_id, UTF-8 bytes or None) of Arrow batches with the columns doc_id and text.

    The bytes are taken from the Arrow buffer one row at a time, so a batch is never held twice."""
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        col = batch.column("text")
        col = col.cast(pa.large_binary()) if pa.types.is_large_string(col.type) else col.cast(pa.binary())
        for i, d in enumerate(ids):
            yield d, col[i].as_py()


def total_bytes(docs: DataFrame) -> int:
    """Bytes of text, summed by Spark; one number reaches the driver."""
    return int(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)


def bucket_count(amount: float, per_bucket: float, least: int = 32) -> int:
    return max(least, -(-int(amount) // int(per_bucket)))

