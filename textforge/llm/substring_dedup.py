"""Substring dedup of word windows with a count-min prefilter.

A window is ``window`` consecutive words of one document. A window goes if its word sequence also starts in a document
with a smaller doc_id, and with it every word that it covers.

1. Sketch: each task counts the windows of its documents (a document counts a window once); the tasks' sketches are merged
   cell by cell. The merged sketch overestimates, so a window that it takes for unique is unique.
2. Exact grouping: a second pass sends only windows estimated as repeated, once for each batch with the smallest doc_id
   that has it there, to the bucket of their hash. Windows are told apart by a 128-bit fingerprint; the bucket keeps those
   that occur in two documents or more, with the smallest doc_id, as sorted arrays in the shared folder.
3. Removal: a third pass looks every window up in these memory-mapped arrays and leaves the covered words out.

A copied passage reaches a bucket once for each batch of documents, however many copies there are, and no text is shuffled.

Defined cases: a null or empty text has no words; a text of fewer words than the window keeps all; rows without a doc_id
are left out; rows that repeat a doc_id are each judged, and do not count as smaller than one another; empty tables work;
further columns are ignored. A text of any length is taken whole: its words and windows are arrays of one task.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from textforge._ship import by_value
from textforge.llm.common import (MULT, PACKED, Sketch, SortedFiles, arrays_of, bucket_bits, edges_of, id_text, mix, pack_arrays, packed_batch,
                                  powers, save_array, shared_dir, total_bytes, word_batches, word_hashes)

by_value(__name__)

SECOND = 0xD6E8FEB86659FD93 | 1  # multiplier of the second half of the fingerprint
ROWS = "bucket int, n long"


def fingerprints(h: np.ndarray, window: int, second: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Both halves of the fingerprint of every window of a document's word hashes."""
    n = len(h) - window + 1
    if n < 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    out = []
    for base in (MULT, SECOND)[: 1 + second]:
        s = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(h * powers(base, len(h)), out=s[1:])
        out.append(mix((s[window:] - s[:-window]) * powers(pow(base, -1, 1 << 64), n)))
    return out[0], out[-1]


def batch_windows(held, window: int, second: bool = True):
    """Of a batch: fingerprint halves of all windows, doc_id of each, and the number of windows of each document."""
    found = [fingerprints(word_hashes(text.split()), window, second) for _, text in held]
    sizes = np.fromiter((len(a) for a, _ in found), np.int64, len(found))
    ids = np.repeat(np.array([d for d, _ in held], np.int64), sizes)
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found]), ids, sizes


def repeated_windows(texts: DataFrame, window: int, amount: int, bucket_windows: float = 4_000_000) -> tuple[str, int, list[int]]:
    """Sorted arrays (window, check, owner) of the windows that start in several documents: folder, bits, buckets."""
    folder = shared_dir(texts.sparkSession, "substring-dedup")
    expected = amount / 6  # words
    sketch = Sketch.sized(folder, expected, 2, bucket_windows)

    def count(batches):
        for held in word_batches(batches):
            a, _, ids, sizes = batch_windows(held, window, False)
            if len(a):
                # distinct by document: the same window twice in one document is no repetition
                order = np.lexsort((ids, a))
                a, ids = a[order], ids[order]
                yield packed_batch(sketch.counted(a[np.append(True, (a[1:] != a[:-1]) | (ids[1:] != ids[:-1]))]))

    present = sketch.build(texts.mapInArrow(count, PACKED))
    bits = bucket_bits(expected, bucket_windows)

    def send(batches):
        files = sketch.open(present)
        for held in word_batches(batches):
            a, b, ids, _ = batch_windows(held, window)
            at = np.flatnonzero(sketch.repeated(files, a)) if len(a) else np.zeros(0, np.int64)
            if len(at):
                a, b, ids = a[at], b[at], ids[at]
                order = np.lexsort((ids, b, a))
                a, b, ids = a[order], b[order], ids[order]
                first = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
                # several documents of this batch have the window: then it is repeated, whatever other batches hold
                last = np.append(first[1:], len(a)) - 1
                several = (ids[last] != ids[first]).astype(np.uint64)
                a, b, ids = a[first], b[first], ids[first]
                edges = edges_of(a, bits)
                yield packed_batch([(n, pack_arrays(a[x:y], b[x:y], ids[x:y], several[x:y])) for n, (x, y) in enumerate(zip(edges, edges[1:])) if y > x])

    def group(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        a, b, ids, several = (np.concatenate(x) for x in arrays_of(table, 4))
        ids = ids.view(np.int64)
        order = np.lexsort((ids, b, a))
        a, b, ids, several = a[order], b[order], ids[order], several[order]
        first = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
        last = np.append(first[1:], len(a)) - 1
        keep = (ids[last] != ids[first]) | (np.add.reduceat(several, first) > 0)
        first = first[keep]
        for name, x in (("window", a), ("check", b), ("owner", ids)):
            save_array(folder, f"{name}-{bucket}", x[first])
        return pa.table({"bucket": pa.array([bucket], pa.int32()), "n": pa.array([len(first)], pa.int64())})

    got = texts.mapInArrow(send, PACKED).groupBy("bucket").applyInArrow(group, ROWS).collect()
    return folder, bits, sorted(r.bucket for r in got if r.n)


def dedup(docs: DataFrame, window: int = 50, with_text: bool = False, bucket_windows: float = 4_000_000) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, spans (start and end word of every removed run), and the kept text."""
    texts = id_text(docs).filter("doc_id is not null")
    folder, bits, present = repeated_windows(texts, window, total_bytes(texts), bucket_windows)
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(span), pa.string()]
    names = ["doc_id", "n_words", "n_removed", "kept_sha256", "spans", "text"]

    def remove(batches):
        known = SortedFiles(folder, "window", bits, present, ["check", "owner"])
        for held in word_batches(batches):
            a, b, ids, sizes = batch_windows(held, window)
            hit = known.find(a, b, "check")
            gone = hit["found"] & (hit["owner"] < ids)
            rows, at = [], 0
            for (doc, text), n in zip(held, sizes.tolist()):
                words = text.split()
                starts = np.flatnonzero(gone[at : at + n])
                at += n
                cover = np.zeros(len(words) + 1, np.int64)
                np.add.at(cover, starts, 1)
                np.add.at(cover, starts + window, -1)
                out = np.cumsum(cover[:-1]) > 0
                kept = b" ".join(w for w, x in zip(words, out.tolist()) if not x) if len(starts) else b" ".join(words)
                cuts = np.flatnonzero(np.diff(np.concatenate([[False], out, [False]]).astype(np.int8))).reshape(-1, 2)
                rows.append((doc, len(words), int(out.sum()), hashlib.sha256(kept).hexdigest(), [{"start": int(x), "end": int(y)} for x, y in cuts], kept.decode() if with_text else None))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    out = texts.mapInArrow(remove, "doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<struct<start:long,end:long>>, text string")
    return out if with_text else out.drop("text")
