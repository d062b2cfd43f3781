"""Language-model scoring: an interpolated modified Kneser-Ney bigram model, counted in Spark.

1. Words. Each task counts the word hashes of a batch; the counts meet in buckets of the hash, which write sorted arrays
   of hashes and counts. A word's id is its place in these arrays. A document's end is a word of its own; it is also the
   context of the next document's first word.
2. Bigrams. Each task counts the id pairs of a batch; they meet in the bucket of the context word, or of the following
   word where a context is so frequent that it would fill a bucket. A bucket writes sorted arrays of pairs and counts, and
   for each of its contexts the numbers of continuations seen once, twice and more often.
3. Continuations. The buckets' distinct pairs are counted by the following word in the same way.
4. Scoring. Workers memory-map these arrays from the shared folder and look the pairs of a batch up in sorted order.

What reaches the driver is a few numbers for each bucket, with the frequent contexts (at most a few for each bucket).

    P(w|u) = max(c(uw) - D(c(uw)), 0) / c(u) + g(u) P(w)      g(u) = (D1 N1(u) + D2 N2(u) + D3 N3+(u)) / c(u)
    P(w) = max(k(w) - D'(k(w)), 0) / K + g' / (V + 1)

with k(w) the number of words seen before w, K their sum, and the discounts D of one, two, more counts estimated from the
numbers of pairs (words) with counts one to four. The order is 2: a third order's arrays would not fit the disk limit.

Defined cases: a null text is empty (one token, the end); rows without a doc_id are left out; rows that repeat a doc_id
are each scored, and each learned from; without training rows every token has base probability 1 / (V + 1) = 1; an empty
table gives no rows; further columns are ignored. A text of any length is scored whole, as one task's arrays of words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textforge._ship import by_value
from textforge.llm.common import (PACKED, Files, arrays_of, bucket_bits, id_text, pack_arrays, packed_batch, save_array, shared_dir, summed,
                                  total_bytes, totals, unpack_arrays, word_batches, word_hashes)
from textforge.session import materialize

by_value(__name__)

END = np.uint64(0x5EEDED0C0FFEE)  # the hash that stands for a document's end
MANIFEST = "bucket int, kind string, numbers array<long>"


def token_hashes(texts: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, document ends included, and the number of tokens of each document."""
    parts, lengths = [], []
    for _, text in texts:
        h = word_hashes(text.lower().split())
        parts += [h, np.array([END])]
        lengths.append(len(h) + 1)
    return np.concatenate(parts), np.array(lengths, np.int64)


def manifest(rows: list[tuple[int, str, list[int]]]) -> pa.Table:
    b, k, n = zip(*rows)
    return pa.table({"bucket": pa.array(b, pa.int32()), "kind": pa.array(k, pa.string()), "numbers": pa.array(n, pa.list_(pa.int64()))})


class Words:
    """The sorted word arrays: lookup of ids, counts and continuation counts."""

    def __init__(self, folder: str, bits: int, sizes: list[int]):
        self.folder, self.bits = folder, bits
        self.first = np.append(0, np.cumsum(sizes)).astype(np.int64)
        self.total = int(self.first[-1])
        self.hashes = Files(folder, "words")
        self.columns: dict[str, Files] = {}

    def ids(self, sorted_hashes: np.ndarray) -> np.ndarray:
        """Ids of sorted hashes; -1 for an unknown word."""
        out = np.full(len(sorted_hashes), -1, np.int64)
        edges = np.searchsorted(sorted_hashes, np.arange(1, 1 << self.bits, dtype=np.uint64) << np.uint64(64 - self.bits))
        edges = np.concatenate([[0], edges, [len(sorted_hashes)]])
        for b in np.flatnonzero(edges[:-1] < edges[1:]).tolist():
            part, have = sorted_hashes[edges[b] : edges[b + 1]], self.hashes[b]
            if len(have):
                at = np.minimum(np.searchsorted(have, part), len(have) - 1)
                out[edges[b] : edges[b + 1]] = np.where(have[at] == part, at + self.first[b], -1)
        return out

    def values(self, name: str, ids: np.ndarray) -> np.ndarray:
        """Entries of an array by sorted ids (-1: 0)."""
        out = np.zeros(len(ids), np.int64)
        edges = np.searchsorted(ids, self.first)
        files = self.columns.setdefault(name, Files(self.folder, name))
        for b in np.flatnonzero(edges[:-1] < edges[1:]).tolist():
            out[edges[b] : edges[b + 1]] = files[b][ids[edges[b] : edges[b + 1]] - self.first[b]]
        return out

    def bucket(self, ids: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, ids, side="right") - 1


def spread(words: Words, frequent: np.ndarray, u: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Bucket of pairs: the context's, or the following word's if the context is frequent."""
    hot = np.isin(u, frequent) if len(frequent) else np.zeros(len(u), bool)
    return np.where(hot, words.bucket(w), words.bucket(u))


class PairKeys:
    """The pairs of a bucket as 64-bit keys: the context's place among the bucket's own words or, after these, among the frequent
    ones, then the id of the following word. Buckets have a bounded size, so this holds for some 10^12 distinct words."""

    def __init__(self, words: Words, frequent: np.ndarray):
        self.first, self.frequent = words.first, frequent
        self.bits = max(1, words.total.bit_length())
        if (int(np.diff(self.first).max(initial=0)) + len(frequent)).bit_length() + self.bits > 64:
            raise ValueError(f"{words.total} distinct words do not fit the pairs' keys")

    def join(self, bucket: int, u: np.ndarray, w: np.ndarray) -> np.ndarray:
        low, high = self.first[bucket], self.first[bucket + 1]
        place = u - low
        if len(self.frequent):
            at = np.minimum(np.searchsorted(self.frequent, u), len(self.frequent) - 1)
            place = np.where(self.frequent[at] == u, high - low + at, place)
        return (place.astype(np.uint64) << np.uint64(self.bits)) | w.astype(np.uint64)

    def split(self, bucket: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Contexts, following words, and whether the context is one of the bucket's own and not frequent."""
        low, high = self.first[bucket], self.first[bucket + 1]
        place, w = (keys >> np.uint64(self.bits)).astype(np.int64), (keys & np.uint64((1 << self.bits) - 1)).astype(np.int64)
        own = place < high - low
        u = place + low
        u[~own] = self.frequent[place[~own] - (high - low)]
        return u, w, own


def merged_pairs(payloads, keys: PairKeys, bucket: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pair keys of a bucket and their counts. One payload at a time is unpacked, counts are kept in few bytes, and the parts
    are let go before they are sorted: the task holds its pairs about four times, not ten."""
    parts: list = []
    for payload in payloads:
        du, w, c = unpack_arrays(payload, 3)
        parts.append((keys.join(bucket, np.cumsum(du).astype(np.int64), w.astype(np.int64)), c.astype(np.min_scalar_type(int(c.max(initial=0))))))
        del du, w, c
    k, c = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    parts.clear()
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    del order
    return totals(k, c)


def discounts(n: list[int]) -> list[float]:
    """Discounts of counts 1, 2 and more (index 0: none) from the numbers of items with counts 1 to 4."""
    n1, n2, n3, n4 = n
    y = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
    d = [0.0, 1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return [min(max(x, 0.0), float(i)) for i, x in enumerate(d)]


def sums(notes: DataFrame, kind: str, n: int) -> list[int]:
    """Sums over the buckets of the ``n`` numbers of a kind of note."""
    row = notes.filter(F.col("kind") == kind).agg(*[F.sum(F.get("numbers", F.lit(i))).alias(f"s{i}") for i in range(n)]).first()
    return [int(x or 0) for x in row]


def train(docs: DataFrame, bucket_bytes: int = 16_000_000) -> dict:
    """Counts the training rows into sorted arrays in a shared folder; returns what scoring needs to open them."""
    texts = id_text(docs)
    folder = shared_dir(docs.sparkSession, "kneser-ney")
    bits = bucket_bits(total_bytes(texts), bucket_bytes)
    buckets = 1 << bits

    # 1. words
    def count_words(batches):
        for held in word_batches(batches):
            h, c = np.unique(token_hashes(held)[0], return_counts=True)
            edges = np.append(np.searchsorted(h, np.arange(buckets, dtype=np.uint64) << np.uint64(64 - bits)), len(h))
            yield packed_batch([(b, pack_arrays(h[x:y], c[x:y])) for b, (x, y) in enumerate(zip(edges, edges[1:])) if y > x])

    def merge_words(table: pa.Table) -> pa.Table:
        b = table.column("bucket")[0].as_py()
        h, c = summed(*arrays_of(table, 2))
        save_array(folder, f"words-{b}", h)
        save_array(folder, f"counts-{b}", c.astype(np.int64))
        top = np.argsort(c)[::-1][:8]  # a frequent context is one of its bucket's largest
        return manifest([(b, "size", [len(h), int(c.sum())])] + [(b, "top", [int(i), int(c[i])]) for i in top])

    got = texts.mapInArrow(count_words, PACKED).groupBy("bucket").applyInArrow(merge_words, MANIFEST).collect()
    sizes, tokens = [0] * buckets, 0
    for r in got:
        if r.kind == "size":
            sizes[r.bucket], tokens = r.numbers[0], tokens + r.numbers[1]
    for b in {*range(buckets)} - {r.bucket for r in got}:
        save_array(folder, f"words-{b}", np.zeros(0, np.uint64))
        save_array(folder, f"counts-{b}", np.zeros(0, np.int64))
    first = np.append(0, np.cumsum(sizes))
    frequent = np.array(sorted(int(first[r.bucket] + r.numbers[0]) for r in got if r.kind == "top" and r.numbers[1] * buckets > tokens), np.int64)

    # 2. pairs
    def count_pairs(batches):
        words = Words(folder, bits, sizes)
        for held in word_batches(batches):
            distinct, at = np.unique(token_hashes(held)[0], return_inverse=True)
            ids = words.ids(distinct)
            # numbers of the batch's words tell its pairs apart; each text has an end, the context of the first word
            pairs, c = np.unique(np.append(np.searchsorted(distinct, END), at[:-1]).astype(np.int64) * len(distinct) + at, return_counts=True)
            u, w = ids[pairs // len(distinct)], ids[pairs % len(distinct)]
            b = spread(words, frequent, u, w)
            order = np.lexsort((w, u, b))
            edges = np.searchsorted(b[order], np.arange(buckets + 1))
            rows = []
            for n, (x, y) in enumerate(zip(edges, edges[1:])):
                if y > x:
                    o = order[x:y]
                    rows.append((n, pack_arrays(np.diff(u[o], prepend=0), w[o], c[o])))
            yield packed_batch(rows)

    def merge_pairs(table: pa.Table) -> pa.Table:
        b = table.column("bucket")[0].as_py()
        words = Words(folder, bits, sizes)
        keys = PairKeys(words, frequent)
        pairs, c = merged_pairs((x.as_py() for x in table.column("payload")), keys, b)
        save_array(folder, f"pairs-{b}", pairs)
        save_array(folder, f"pair_counts-{b}", c.astype(np.min_scalar_type(int(c.max()))))
        rows = [(b, "counts", [int((c == i).sum()) for i in (1, 2, 3, 4)] + [len(c)])]
        u, w, own = keys.split(b, pairs)
        low, high = words.first[b], words.first[b + 1]
        for name, has in (("n1", c == 1), ("n2", c == 2), ("n3", c > 2)):
            save_array(folder, f"{name}-{b}", np.bincount(u[own & has] - low, minlength=high - low).astype(np.uint32))
            for x, n in zip(*np.unique(u[~own & has], return_counts=True)):
                rows.append((b, name, [int(x), int(n)]))
        # distinct pairs by the following word, for the next exchange
        w, n = np.unique(w, return_counts=True)
        edges = np.searchsorted(w, words.first)
        parts = [(t, pack_arrays(w[x:y] - words.first[t], n[x:y])) for t, (x, y) in enumerate(zip(edges, edges[1:])) if y > x]
        out = [(x, k, v, None) for x, k, v in rows] + [(t, "follow", None, p) for t, p in parts]
        t, k, v, p = zip(*out)
        return pa.table({"bucket": pa.array(t, pa.int32()), "kind": pa.array(k, pa.string()), "numbers": pa.array(v, pa.list_(pa.int64())), "payload": pa.array(p, pa.binary())})

    merged = materialize(texts.mapInArrow(count_pairs, PACKED).groupBy("bucket").applyInArrow(merge_pairs, MANIFEST + ", payload binary"), "kneser-ney-pairs")
    have = {r.bucket for r in merged.filter("kind = 'counts'").select("bucket").collect()}
    for b in {*range(buckets)} - have:
        save_array(folder, f"pairs-{b}", np.zeros(0, np.uint64))
        save_array(folder, f"pair_counts-{b}", np.zeros(0, np.uint8))
        for name in ("n1", "n2", "n3"):
            save_array(folder, f"{name}-{b}", np.zeros(sizes[b], np.uint32))
    pair_counts = sums(merged, "counts", 5)
    hot = {name: np.zeros(len(frequent), np.int64) for name in ("n1", "n2", "n3")}  # of the frequent contexts
    for r in merged.filter("kind in ('n1', 'n2', 'n3')").groupBy("kind", F.get("numbers", F.lit(0)).alias("word")).agg(F.sum(F.get("numbers", F.lit(1))).alias("n")).collect():
        hot[r.kind][np.searchsorted(frequent, r.word)] = r.n

    # 3. continuations
    def merge_follow(table: pa.Table) -> pa.Table:
        b = table.column("bucket")[0].as_py()
        k, n = summed(*arrays_of(table, 2))
        dense = np.zeros(sizes[b], np.uint32)
        dense[k.astype(np.int64)] = n
        save_array(folder, f"follow-{b}", dense)
        return manifest([(b, "follow", [int((n == i).sum()) for i in (1, 2, 3, 4)] + [len(n), int(n.sum())])])

    follow = materialize(merged.filter("kind = 'follow'").select("bucket", "payload").groupBy("bucket").applyInArrow(merge_follow, MANIFEST), "kneser-ney-follow")
    for b in {*range(buckets)} - {r.bucket for r in follow.select("bucket").collect()}:
        save_array(folder, f"follow-{b}", np.zeros(sizes[b], np.uint32))
    words_with = sums(follow, "follow", 6)
    d1 = discounts(words_with[:4])
    kinds = words_with[5]
    spare = (d1[1] * words_with[0] + d1[2] * words_with[1] + d1[3] * (words_with[4] - words_with[0] - words_with[1])) / kinds if kinds else 1.0
    return {"folder": folder, "bits": bits, "sizes": sizes, "tokens": tokens, "frequent": frequent.tolist(), "hot": hot,
            "d2": discounts(pair_counts[:4]), "d1": d1, "kinds": kinds, "spare": spare}


class Model:
    """The memory-mapped arrays of a trained model in a worker."""

    def __init__(self, model: dict):
        self.__dict__.update(model)
        self.words = Words(self.folder, self.bits, self.sizes)
        self.frequent = np.array(self.frequent, np.int64)
        self.keys = PairKeys(self.words, self.frequent)
        self.pairs, self.counts = Files(self.folder, "pairs"), Files(self.folder, "pair_counts")
        self.end = self.words.ids(np.array([END]))[0]

    def pair_counts(self, u: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Counts of distinct pairs that are sorted by u and w."""
        out = np.zeros(len(u), np.int64)
        known = np.flatnonzero((u >= 0) & (w >= 0))
        b = spread(self.words, self.frequent, u[known], w[known])
        order = known[np.argsort(b, kind="stable")]
        edges = np.searchsorted(np.sort(b), np.arange((1 << self.bits) + 1))
        for n in np.flatnonzero(edges[:-1] < edges[1:]).tolist():
            have, o = self.pairs[n], order[edges[n] : edges[n + 1]]
            if len(have):
                key = self.keys.join(n, u[o], w[o])
                at = np.minimum(np.searchsorted(have, key), len(have) - 1)
                out[o] = np.where(have[at] == key, self.counts[n][at], 0)
        return out

    def score(self, texts: list[tuple]) -> tuple[np.ndarray, ...]:
        """Of each document: tokens, known tokens, base score and model score."""
        h, lengths = token_hashes(texts)
        starts = np.cumsum(lengths) - lengths
        distinct, at = np.unique(h, return_inverse=True)
        ids = self.words.ids(distinct)
        order = np.argsort(ids, kind="stable")
        back = np.argsort(order, kind="stable")
        value = lambda name: self.words.values(name, ids[order])[back]  # noqa: E731  of each distinct word
        count, follow, n1, n2, n3 = (value(x) for x in ("counts", "follow", "n1", "n2", "n3"))
        place = np.minimum(np.searchsorted(self.frequent, ids), max(0, len(self.frequent) - 1))
        often = self.frequent[place] == ids if len(self.frequent) else np.zeros(len(ids), bool)
        for name, n in (("n1", n1), ("n2", n2), ("n3", n3)):
            n[often] = self.hot[name][place[often]]
        vocabulary = self.words.total
        base = np.log10((count + 1) / (self.tokens + vocabulary + 1))
        d1, d2 = np.array(self.d1), np.array(self.d2)
        low = self.spare / (vocabulary + 1) + np.maximum(follow - d1[np.minimum(follow, 3)], 0) / max(self.kinds, 1)
        with np.errstate(divide="ignore", invalid="ignore"):
            share = np.where(count > 0, (d2[1] * n1 + d2[2] * n2 + d2[3] * n3) / count, 1.0)  # of a context, for the lower order
        # contexts: the word before, or a document's end before the first word
        end_at = np.searchsorted(distinct, END)
        before = np.append(end_at, at[:-1])
        before[starts] = end_at
        pairs, place = np.unique(before.astype(np.int64) * len(distinct) + at, return_inverse=True)
        pu, pw = pairs // len(distinct), pairs % len(distinct)
        c = self.pair_counts(ids[pu], ids[pw])
        with np.errstate(divide="ignore", invalid="ignore"):
            p = np.where(count[pu] > 0, np.maximum(c - d2[np.minimum(c, 3)], 0) / count[pu], 0) + share[pu] * low[pw]
        return lengths, np.add.reduceat((count > 0)[at].astype(np.int64), starts), np.add.reduceat(base[at], starts), np.add.reduceat(np.log10(p)[place], starts)


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score (log10 of the text's probability), perplexity."""

    def run(batches):
        arrays = Model(model)
        for held in word_batches(batches):
            n, known, base, total = arrays.score(held)
            yield pa.RecordBatch.from_arrays(
                [pa.array([d for d, _ in held], pa.int64()), pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(np.full(len(held), model["tokens"])), pa.array(base), pa.array(total), pa.array(10.0 ** (-total / n))],
                names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])

    return id_text(docs).mapInArrow(run, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double")


def held_out(part: int, of: int) -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(of)) == part


def score_held_out(docs: DataFrame, part: int = 2, of: int = 7, bucket_bytes: int = 16_000_000) -> DataFrame:
    """Learns from the rows whose crc32(doc_id) modulo ``of`` is not ``part``, and scores all rows."""
    rows = id_text(docs).filter("doc_id is not null")
    model = train(rows.filter(~held_out(part, of)), bucket_bytes)
    return score(rows, model).withColumn("held_out", held_out(part, of))
