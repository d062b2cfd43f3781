"""Benchmark decontamination by winnowing.

A text's words give rolling k-gram hashes; of every ``window - k + 1`` consecutive hashes the minimum (leftmost of equal
ones) is kept as a fingerprint. Two texts that share ``window`` consecutive words keep the same fingerprint inside them,
so no shared span of that length is missed. An item with fewer words is one window of its own length; for each such length
(there are fewer than ``window``) the documents' fingerprints are all their grams of that length.

1. The documents' fingerprints are joined with the benchmark's. Spark broadcasts the benchmark's side only when its size
   is below the session's broadcast threshold, else both sides are shuffled. The same holds, by a count of rows, for
   the hits in step 2.
2. Every hit is extended to all windows of the document that contain it. Their 128-bit digests are joined with those of
   the items' windows, which leaves exactly the shared windows.
3. A document's hit words are the union of its shared windows, summed with a window function over their sorted starts.

Words are the runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z are lower-cased.

Defined cases: a null or empty text has no words and cannot be hit; documents without a doc_id, and items without an
item_id or words, are left out; equal items all count; rows that repeat a doc_id give one result row: their word counts
add, and a place counts once if it is hit in any of them; empty tables work; further columns are ignored. A text of any length
is taken whole, as one task's arrays of words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textforge._ship import by_value
from textforge.llm.common import ALNUM, id_text, rolling, small_side, text_rows, window_min, word_hashes
from textforge.session import materialize

by_value(__name__)

WORDS = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"


def alnum_words(text: bytes | None) -> list[bytes]:
    return ALNUM.findall(text.lower()) if text else []


def winnow(hashes: np.ndarray, span: int) -> np.ndarray:
    """Positions of the (leftmost) minimum of every ``span`` consecutive hashes; of all, if there are fewer."""
    n = len(hashes)
    if n == 0 or span <= 1:
        return np.arange(n)
    if n <= span:
        return np.array([int(hashes.argmin())])
    least = window_min(hashes, span)
    # the next place, from i on, of the value that is the least of the window at i
    at = np.full(len(least), -1)
    for shift in range(span):
        free = at < 0
        at[free & (hashes[shift : shift + len(least)] == least)] = shift
    return np.unique(at + np.arange(len(least)))


def kinds_of(window: int, k: int, short: list[int]) -> list[tuple[int, int, int]]:
    """(words of a shared window, words of a fingerprinted gram, grams in a winnowing window)."""
    return [(window, k, window - k + 1)] + [(m, m, 1) for m in short]


def fingerprints(texts: DataFrame, kinds: list[tuple[int, int, int]], items: bool) -> DataFrame:
    """Rows (doc_id, len, pos, h); a document also has a first row with len 0 and its number of words as pos."""
    names = ["doc_id", "len", "pos", "h"]

    def run(batches):
        cols: tuple[list, ...] = ([], [], [], [])
        held = 0
        for doc, text in text_rows(batches):
            words = alnum_words(text)
            h, n = word_hashes(words), len(words)
            found = [] if items else [(0, np.array([n]), np.zeros(1, np.uint64))]
            for length, k, span in kinds:
                if n >= length if not items else n == length or n > length == kinds[0][0]:
                    grams = rolling(h, k)
                    at = winnow(grams, span)
                    found.append((length, at, grams[at]))
            for length, at, grams in found:
                for col, x in zip(cols, (np.full(len(at), doc), np.full(len(at), length, np.int32), at.astype(np.int64), grams.view(np.int64))):
                    col.append(x)
                held += len(at)
            if held > 500_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in cols], names=names)
                cols, held = ([], [], [], []), 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in cols], names=names)

    return texts.mapInArrow(run, "doc_id long, len int, pos long, h long")


def window_digests(texts: DataFrame, kinds: list[tuple[int, int, int]]) -> DataFrame:
    """Digests (a, b) of windows: those around the hits in the column ``hits``, or all of an item, which has no hits."""
    grams = {length: k for length, k, _ in kinds}

    def around(hits, n):
        for x in hits:
            length, pos = x["len"], x["pos"]
            for s in range(max(0, pos - length + grams[length]), min(pos, n - length) + 1):
                yield length, s

    def run(batches):
        for batch in batches:
            rows = []
            hits = batch.column("hits").to_pylist()
            for i, (doc, text) in enumerate(text_rows([batch])):
                words = alnum_words(text)
                length = min(kinds[0][0], len(words))
                todo = set(around(hits[i], len(words))) if hits[i] is not None else {(length, s) for s in range(len(words) - length + 1)} if words else ()
                for length, s in todo:
                    digest = xxhash.xxh3_128_digest(b" ".join(words[s : s + length]))
                    rows.append((doc, s, length, digest))
            cols = list(zip(*rows)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.binary()))], names=["doc_id", "start", "len", "digest"])

    return texts.mapInArrow(run, "doc_id long, start long, len int, digest binary")


def shared_windows(docs: DataFrame, items: DataFrame, window: int = 10, k: int = 6) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n_words of every row; doc_id, start, len, item_id of every shared window)."""
    texts = id_text(docs).filter("doc_id is not null")
    items = id_text(items, "item_id").filter("doc_id is not null")
    lengths = items.select(F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORDS)).alias("n"))
    short = sorted(r.n for r in lengths.filter((F.col("n") > 0) & (F.col("n") < window)).distinct().collect())  # fewer than window
    kinds = kinds_of(window, min(k, window), short)
    prints = materialize(fingerprints(items, kinds, True).select("len", "h").distinct(), "decontaminate-items")
    known = prints.withColumn("known", F.lit(True))
    found = fingerprints(texts, kinds, False).join(known, ["len", "h"], "left").filter("known or len = 0")
    found = materialize(found.select("doc_id", "len", "pos"), "decontaminate-hits")
    hits = found.filter("len > 0").groupBy("doc_id").agg(F.collect_set(F.struct("len", "pos")).alias("hits"))
    # the texts stay where they are while the hits are few
    inside = window_digests(texts.join(small_side(hits, found.filter("len > 0").count()), "doc_id"), kinds)
    whole = window_digests(items.withColumn("hits", F.lit(None).cast("array<struct<len:int,pos:long>>")), kinds)
    whole = whole.select(F.col("doc_id").alias("item_id"), "len", "digest").distinct()
    return found.filter("len = 0").select("doc_id", F.col("pos").alias("n_words")), inside.join(whole, ["len", "digest"]).select("doc_id", "start", "len", "item_id")


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10, k: int = 6) -> DataFrame:
    """doc_id, n_words, n_hit, items (sorted item ids), spans (start and end of every maximal run of hit words)."""
    counts, found = shared_windows(docs, items, window, k)
    found = materialize(found, "decontaminate-windows")
    by = W.partitionBy("doc_id").orderBy("start", "end")
    spans = found.select("doc_id", "start", (F.col("start") + F.col("len")).alias("end")).distinct()
    spans = spans.withColumn("reach", F.max("end").over(by.rowsBetween(W.unboundedPreceding, -1)))
    spans = spans.withColumn("run", F.sum(F.when(F.col("start") <= F.col("reach"), 0).otherwise(1)).over(by))
    spans = spans.groupBy("doc_id", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    spans = spans.groupBy("doc_id").agg(F.sum(F.col("end") - F.col("start")).alias("n_hit"), F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    named = found.groupBy("doc_id").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    hit = spans.join(named, "doc_id")
    rows = counts.groupBy("doc_id").agg(F.sum("n_words").alias("n_words"))
    return rows.join(hit, "doc_id", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<long>")).alias("items"), "spans")
