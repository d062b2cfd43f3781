"""N-gram Jaccard join by vertical partitioning.

A document's set is its distinct shingles of ``size`` words. Two documents link when their sets' Jaccard similarity is
``percent`` / 100 or more. The global order of shingles is (number of documents, hash), rare ones first; it is cut into
fragments. For a pair of documents the partial overlap is counted in each fragment separately, and Spark sums the partial
overlaps of a pair. What the steps before that leave out cannot link:

1. Equal sets are one class, represented by its smallest doc_id.
2. A merged sketch tells which shingles occur once. With u of n shingles occurring once, a document needs
   (100 - percent) n >= 100 u to link at all; few others remain. Their sets are written once, in buckets of the doc_id.
3. Prefix filter: documents that link share one of the first n - ceil(percent n / 100) + 1 shingles in the global order.
   Each such shingle names as leader the document with the fewest shingles of its own, and every document is paired with
   the leaders of its prefix, not with all others. Links to leaders make the first components.
4. For pairs of different components that share a prefix shingle, the overlaps I with its leader, known by now, bound the
   overlap of the pair: at most I of the one and the shared shingles outside the leader of the other. Each prefix shingle
   keeps the extremes of these bounds, and each document is sent on only if it fits into them. Where two such documents
   meet, bitmaps of what either lacks of the leader bound the pair once more, and only pairs that pass are counted, again
   by fragments. Pairs inside a component change nothing.

So a large group of near copies is joined through its leader, and no list of all its pairs is ever made; yet every link
between different components is found.

Defined cases: A-Z are lower-cased; a text of fewer words than ``size`` has the whole sequence as its only shingle; a null
text, or one without words, has an empty set and links with nothing; documents without a doc_id are left out; of rows
that repeat a doc_id one counts (that with the smallest fingerprint), so the result has each doc_id once; an empty table
gives no rows; further columns are ignored. A text of any length is taken whole: its words and set are arrays of one task.
Of documents that could lead a shingle alike the one with the smallest doc_id does.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textforge._ship import by_value
from textforge.llm.common import (MULT, PACKED, Files, Sketch, SortedFiles, arrays_of, bucket_bits, edges_of, id_text, mix, pack_arrays,
                                  packed_batch, rolling, save_array, shared_dir, summed, total_bytes, unpack_arrays, word_batches, word_hashes)
from textforge.llm.components import components
from textforge.session import materialize

by_value(__name__)

DONE = "bucket int"


def shingles(text: bytes, size: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    h = word_hashes(text.lower().split())
    if not len(h):
        return h
    if len(h) < size:
        return rolling(h, len(h)) + np.uint64(len(h))
    return np.unique(rolling(h, size))


def fingerprint(s: np.ndarray) -> tuple[int, int]:
    d = xxhash.xxh3_128_intdigest(s.tobytes())
    return d >> 64, d & (2**64 - 1)


def done(bucket: int) -> pa.Table:
    return pa.table({"bucket": pa.array([bucket], pa.int32())})


def by_bucket(keys: np.ndarray, bits: int, *columns: np.ndarray) -> list[tuple[int, bytes]]:
    """Columns sorted by key and packed by the key's bucket; the key is the first column."""
    order = np.argsort(keys, kind="stable")
    keys, columns = keys[order], [c[order] for c in columns]
    edges = edges_of(keys, bits)
    return [(b, pack_arrays(keys[x:y], *[c[x:y] for c in columns])) for b, (x, y) in enumerate(zip(edges, edges[1:])) if y > x]


def key_of(ids: np.ndarray) -> np.ndarray:
    return mix(np.asarray(ids, np.int64).view(np.uint64))


def pair_key(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return mix(key_of(x) * np.uint64(MULT) + key_of(y))


def groups_of(sizes: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(sizes)), sizes)


def save_rows(df: DataFrame, folder: str, bits: int, key: str, columns: list[str], names: list[str]) -> list[int]:
    """Rows of a DataFrame (``key``: hash as long) as sorted files; the buckets that have one."""

    def save(table: pa.Table) -> pa.Table:
        b = table.column("bucket")[0].as_py()
        k = table.column(key).to_numpy().view(np.uint64)
        order = np.argsort(k, kind="stable")
        for name, c in zip(names, [k, *[table.column(c).to_numpy() for c in columns]]):
            save_array(folder, f"{name}-{b}", c[order])
        return done(b)

    rows = df.select(F.shiftrightunsigned(F.col(key), 64 - bits).cast("int").alias("bucket"), key, *columns)
    return sorted(r.bucket for r in rows.groupBy("bucket").applyInArrow(save, DONE).collect())


class Sets:
    """The kept documents' sets in the shared folder: sorted by key of the doc_id; shingles in the global order."""

    def __init__(self, folder: str, bits: int):
        self.bits = bits
        self.columns = [Files(folder, x) for x in ("set", "set_doc", "set_size", "set_end", "set_shingle", "set_df")]

    def file(self, bucket: int) -> list[np.ndarray]:
        return [c[bucket] for c in self.columns]

    def get(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(n of each document; the position in ``docs``, shingle and its df of every shared shingle)."""
        keys = key_of(docs)
        n = np.zeros(len(docs), np.int64)
        who, what, often = [], [], []
        bucket = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        for b in np.unique(bucket).tolist():
            at = np.flatnonzero(bucket == b)
            k, _, size, end, shingle, df = self.file(b)
            i = np.searchsorted(k, keys[at])
            n[at] = size[i]
            stop = end[i].astype(np.int64)
            start = np.where(i > 0, end[np.maximum(i - 1, 0)], 0).astype(np.int64)
            m = stop - start
            take = np.repeat(start - (np.cumsum(m) - m), m) + np.arange(m.sum())
            who.append(np.repeat(at, m))
            what.append(shingle[take])
            often.append(df[take])
        return n, *(np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (who, what, often))

    def scan(self, bucket: int) -> tuple[np.ndarray, ...]:
        """(doc_ids, n, sizes of the shared part, shingles, df) of a bucket."""
        _, doc, size, end, shingle, df = self.file(bucket)
        return np.asarray(doc), np.asarray(size), np.diff(np.asarray(end), prepend=0), np.asarray(shingle), np.asarray(df)


class Join(NamedTuple):
    folder: str
    bits: int
    percent: int
    stored: list = []
    pivots: list = []
    led: list = []
    ruled: list = []
    labelled: list = []
    known: list = []

    def prefix(self, n: np.ndarray) -> np.ndarray:
        return n + (-self.percent * n) // 100 + 1

    def prefixes(self, n: np.ndarray, m: np.ndarray, shingle: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(document index, key of a shingle) of the shared shingles in the prefixes; unique ones come first in the order.

        Prefixes have the lesser hashes; mixed once more, they spread evenly over the buckets."""
        q = np.minimum(self.prefix(n) - (n - m), m)
        first = np.cumsum(m) - m
        take = np.repeat(first - (np.cumsum(q) - q), q) + np.arange(q.sum())
        return groups_of(q), mix(shingle[take])

    def buckets(self, spark) -> DataFrame:
        """One row for each bucket of stored sets, dealt over tasks."""
        return spark.createDataFrame([(b,) for b in self.stored], "b int").repartition(max(1, len(self.stored)), "b")


def store_sets(texts: DataFrame, classes: DataFrame, join: Join, size: int, amount: int) -> Join:
    """Steps 1 and 2: writes the sets of the representatives that can link, in the global order."""
    folder, bits, percent = join.folder, join.bits, join.percent
    present = save_rows(classes, folder, bits, "a", ["rep"], ["rep", "rep_doc"])
    sketch = Sketch.sized(folder, amount / 6, 1)

    def representatives(batches):
        known = SortedFiles(folder, "rep", bits, present, ["rep_doc"])
        for held in word_batches(batches, 400_000):
            sets = [shingles(text, size) for _, text in held]
            a = np.fromiter((fingerprint(s)[0] for s in sets), np.uint64, len(sets))
            found = known.find(a)
            yield [(d, s) for (d, _), s, f, r in zip(held, sets, found["found"].tolist(), found["rep_doc"].tolist()) if f and r == d and len(s)]

    def count(batches):
        for docs in representatives(batches):
            if docs:
                h, n = np.unique(np.concatenate([s for _, s in docs]), return_counts=True)
                yield packed_batch(sketch.counted(h, n))

    sketched = sketch.build(texts.mapInArrow(count, PACKED))

    def keep(batches):
        files = sketch.open(sketched)
        for docs in representatives(batches):
            if not docs:
                continue
            m = np.fromiter((len(s) for _, s in docs), np.int64, len(docs))
            flat = np.concatenate([s for _, s in docs])
            twice = sketch.repeated(files, flat)
            shared = np.add.reduceat(twice.astype(np.int64), np.cumsum(m) - m)
            able = (100 - percent) * m >= 100 * (m - shared)
            pick = twice & np.repeat(able, m)
            ids = np.fromiter((d for d, _ in docs), np.int64, len(docs))[able]
            if len(ids):
                yield packed_batch([(0, pack_arrays(ids, m[able], shared[able], flat[pick]))])

    kept = materialize(texts.mapInArrow(keep, PACKED), "ngram-kept")

    def parts(batches):
        for batch in batches:
            for x in batch.column("payload"):
                ids, n, m, flat = unpack_arrays(x.as_py(), 4)
                yield ids.view(np.int64), n.view(np.int64), m.view(np.int64), flat

    def count_exactly(batches):
        for _, _, _, flat in parts(batches):
            h, c = np.unique(flat, return_counts=True)
            yield packed_batch(by_bucket(h, bits, c))

    def add(table: pa.Table) -> pa.Table:
        b = table.column("bucket")[0].as_py()
        h, c = summed(*arrays_of(table, 2))
        save_array(folder, f"shingle-{b}", h[c > 1])
        save_array(folder, f"df-{b}", c[c > 1].astype(np.int64))
        n = np.bincount(np.minimum(c[c > 1], 1000).astype(np.int64), weights=c[c > 1].astype(float), minlength=1001)
        return pa.table({"bucket": pa.array([b], pa.int32()), "weights": pa.array([n.astype(np.int64).tolist()], pa.list_(pa.int64()))})

    counted = materialize(kept.mapInArrow(count_exactly, PACKED).groupBy("bucket").applyInArrow(add, "bucket int, weights array<long>"), "ngram-counts")
    shared_by = sorted(r.bucket for r in counted.select("bucket").collect())

    def deal(batches):
        known = SortedFiles(folder, "shingle", bits, shared_by, ["df"])
        for ids, n, m, flat in parts(batches):
            at = known.find(flat)
            pick = at["found"]
            real = np.add.reduceat(pick.astype(np.int64), np.cumsum(m) - m) if len(flat) else np.zeros(len(m), np.int64)
            real[m == 0] = 0
            able = ((100 - percent) * n >= 100 * (n - real)) & (real > 0)
            who = groups_of(m)
            pick &= able[who]
            who, flat, df = who[pick], flat[pick], at["df"][pick]
            order = np.lexsort((flat, df, who))
            flat, df = flat[order], df[order]
            ids, n, real = ids[able], n[able], real[able]
            key = key_of(ids)
            bucket = (key >> np.uint64(64 - bits)).astype(np.int64)
            of = bucket[groups_of(real)]
            rows = [(b, pack_arrays(ids[s := bucket == b], n[s], real[s], flat[t := of == b], df[t])) for b in np.unique(bucket).tolist()]
            if rows:
                yield packed_batch(rows)

    def store(table: pa.Table) -> pa.Table:
        b = table.column("bucket")[0].as_py()
        ids, n, m, flat, df = (np.concatenate(x) for x in arrays_of(table, 5))
        ids, n, m, df = ids.view(np.int64), n.view(np.int64), m.view(np.int64), df.view(np.int64)
        order = np.argsort(key_of(ids), kind="stable")
        first = np.cumsum(m) - m
        m2 = m[order]
        take = np.repeat(first[order] - (np.cumsum(m2) - m2), m2) + np.arange(m2.sum())
        for name, x in (("set", key_of(ids)[order]), ("set_doc", ids[order]), ("set_size", n[order]), ("set_end", np.cumsum(m2)), ("set_shingle", flat[take]), ("set_df", df[take].astype(np.uint32))):
            save_array(folder, f"{name}-{b}", x)
        return done(b)

    stored = sorted(r.bucket for r in kept.mapInArrow(deal, PACKED).groupBy("bucket").applyInArrow(store, DONE).collect())
    # pivots of the global order: about equal shares of all occurrences
    weights = np.zeros(1001)
    for r in counted.select(F.posexplode("weights").alias("df", "n")).groupBy("df").agg(F.sum("n").alias("n")).collect():  # 1001 rows
        weights[r.df] = r.n
    share, pivots = np.cumsum(weights) / max(1, weights.sum()), []
    for i in range(1, 8):
        df = int(np.searchsorted(share, i / 8))
        below = share[df - 1] if df else 0.0
        inside = (i / 8 - below) / max(share[df] - below, 1e-12) if df < len(share) else 0.0
        pivots.append((df, int(min(max(inside, 0.0), 1.0) * (2**64 - 2049))))
    return join._replace(stored=stored, pivots=pivots)


def fragment_of(shingle: np.ndarray, df: np.ndarray, pivots: list) -> np.ndarray:
    """Fragment of the global order (df, hash) that holds a shingle; very frequent ones share the last df of the table."""
    df = np.minimum(df.astype(np.int64), 1000)
    out = np.zeros(len(shingle), np.int64)
    for d, h in pivots:
        out += (df > d) | ((df == d) & (shingle >= np.uint64(h)))
    return out


WORDS = ["m0", "m1", "m2", "m3"]


def overlaps(pairs: DataFrame, join: Join) -> DataFrame:
    """(x, y, nx, ny, overlap) of pairs (x, y): partial overlaps by fragment, summed for each pair.

    m0 to m3 are a bitmap, by hash, of the shared shingles of y that x lacks: its bits are at most as many as these."""

    def partial(batches):
        sets = Sets(join.folder, join.bits)
        for batch in batches:
            xs, ys = batch.column("x").to_numpy(), batch.column("y").to_numpy()
            for at in range(0, len(xs), 4_000):
                x, y = xs[at : at + 4_000], ys[at : at + 4_000]
                docs, place = np.unique(np.concatenate([x, y]), return_inverse=True)
                n, who, what, df = sets.get(docs)
                order = np.argsort(who, kind="stable")
                who, what, df = who[order], what[order], df[order]
                first = np.searchsorted(who, np.arange(len(docs) + 1))
                ix, iy = place[: len(x)], place[len(x) :]
                codes = np.unique(what, return_inverse=True)[1]
                fragment = fragment_of(what, df, join.pivots)
                cols = []
                step = max(1, 3_000_000 // max(1, int(np.diff(first).max(initial=1))))
                for s in range(0, len(x), step):
                    a, b = ix[s : s + step], iy[s : s + step]
                    take, pair = [], []
                    for side in (a, b):
                        m = first[side + 1] - first[side]
                        take.append(np.repeat(first[side] - (np.cumsum(m) - m), m) + np.arange(m.sum()))
                        pair.append(groups_of(m))
                    take, pair = np.concatenate(take), np.concatenate(pair)
                    key = pair * (int(codes.max(initial=0)) + 1) + codes[take]
                    order = np.argsort(key, kind="stable")
                    both = np.flatnonzero(key[order[1:]] == key[order[:-1]])
                    cell, count = np.unique(pair[order[both]] * 8 + fragment[take[order[both]]], return_counts=True)
                    alone = np.ones(len(key), bool)
                    alone[order[both]] = alone[order[both + 1]] = False
                    alone[: len(alone) - int((first[b + 1] - first[b]).sum())] = False  # only the side of y
                    bit = what[take[alone]] >> np.uint64(56)
                    bits = np.zeros((len(a), 4), np.uint64)
                    np.bitwise_or.at(bits, (pair[alone], (bit >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (bit & np.uint64(63)))
                    cols.append((s + cell // 8, cell % 8, count, *bits[cell // 8].T))
                p, f, c, *m = (np.concatenate(z) for z in zip(*cols))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[p]), pa.array(y[p]), pa.array(n[ix[p]]), pa.array(n[iy[p]]), pa.array(f.astype(np.int32)), pa.array(c.astype(np.int64))]
                    + [pa.array(z.view(np.int64)) for z in m], names=["x", "y", "nx", "ny", "fragment", "overlap", *WORDS])

    rows = pairs.mapInArrow(partial, "x long, y long, nx long, ny long, fragment int, overlap long, m0 long, m1 long, m2 long, m3 long")
    return rows.groupBy("x", "y", "nx", "ny").agg(F.sum("overlap").alias("overlap"), *[F.bit_or(w).alias(w) for w in WORDS])


def linked(counts: DataFrame, percent: int) -> DataFrame:
    return counts.filter(100 * F.col("overlap") >= percent * (F.col("nx") + F.col("ny") - F.col("overlap"))).select(F.col("x").alias("a"), F.col("y").alias("b"))


def pairs_batch(x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], names=["x", "y"])


def able(nx, ny, percent: int):
    return (100 * np.minimum(nx, ny) >= percent * np.maximum(nx, ny))


def leader_pairs(spark, join: Join) -> tuple[Join, DataFrame]:
    """Step 3: the leader of every prefix shingle, and the pairs (document, leader)."""
    folder, bits = join.folder, join.bits

    def candidates(batches):
        sets = Sets(folder, bits)
        for batch in batches:
            for b in batch.column("b").to_pylist():
                docs, n, m, shingle, _ = sets.scan(b)
                who, h = join.prefixes(n, m, shingle)
                own = (n - m)[who]
                order = np.lexsort((docs[who], own, h))
                h, who, own = h[order], who[order], own[order]
                first = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
                count = np.diff(np.append(first, len(h)))
                yield packed_batch(by_bucket(h[first], bits, own[first], docs[who[first]], n[who[first]], count))

    def lead(table: pa.Table) -> pa.Table:
        b = table.column("bucket")[0].as_py()
        h, own, doc, n, count = (np.concatenate(x) for x in arrays_of(table, 5))
        doc = doc.view(np.int64)
        order = np.lexsort((doc, own, h))
        h, doc, n, count = h[order], doc[order], n[order], count[order]
        first = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
        many = np.add.reduceat(count, first) > 1
        for name, x in (("post", h), ("lead", doc), ("lead_size", n.astype(np.int64))):
            save_array(folder, f"{name}-{b}", x[first][many])
        return done(b)

    join = join._replace(led=sorted(r.bucket for r in join.buckets(spark).mapInArrow(candidates, PACKED).groupBy("bucket").applyInArrow(lead, DONE).collect()))

    def pairs(batches):
        sets, posts = Sets(folder, bits), SortedFiles(folder, "post", bits, join.led, ["lead", "lead_size"])
        for batch in batches:
            for b in batch.column("b").to_pylist():
                docs, n, m, shingle, _ = sets.scan(b)
                who, h = join.prefixes(n, m, shingle)
                at = posts.find(h)
                ok = at["found"] & (at["lead"] != docs[who]) & able(n[who], at["lead_size"], join.percent)
                if ok.any():
                    p = np.unique(np.stack([docs[who[ok]], at["lead"][ok]]), axis=1)
                    yield pairs_batch(p[0], p[1])

    return join, join.buckets(spark).mapInArrow(pairs, "x long, y long")


UNKNOWN = -1


class Bounds:
    """Step 4: what the known overlaps with a prefix shingle's leader say about a document's overlap with others."""

    def __init__(self, join: Join):
        self.join = join
        self.posts = SortedFiles(join.folder, "post", join.bits, join.led, ["lead", "lead_size"])
        self.known = SortedFiles(join.folder, "known", join.bits, join.known, ["known_y", "known_overlap", *[f"known_{w}" for w in WORDS]])
        self.labels = SortedFiles(join.folder, "node", join.bits, join.labelled, ["component"])

    def component(self, docs: np.ndarray) -> np.ndarray:
        at = self.labels.find(key_of(docs))
        return np.where(at["found"], at["component"], docs)

    def of(self, docs, n, m, shingle):
        """Of all prefix shingles with several documents: document index, shingle, inside (in the leader's component), need and
        reach, then the overlap with the leader (UNKNOWN: not counted, the whole shared part is given as outside), the shared
        shingles outside it, and the bitmap of what is lacking of it. A pair can only link if need of the one is at most reach of the other, both ways."""
        t = self.join.percent
        who, h = self.join.prefixes(n, m, shingle)
        at = self.posts.find(h)
        ok = at["found"]
        who, h, lead = who[ok], h[ok], at["lead"][ok]
        hit = self.known.find(pair_key(docs[who], lead), lead, "known_y")
        # without a counted overlap (sizes too different) nothing is known but the shared part itself: it bounds either
        none = ~hit["found"] & (lead != docs[who])
        overlap = np.where(none | (lead == docs[who]), m[who], hit["known_overlap"])
        outside = np.where(none, m[who], m[who] - overlap)
        need = t * n[who] - (100 + t) * outside
        reach = (100 + t) * overlap - t * n[who]
        inside = self.component(docs)[who] == self.component(lead)
        lacks = [hit[f"known_{w}"] for w in WORDS]
        return who, h, inside, need, reach, np.where(none, UNKNOWN, overlap), outside, *lacks


def bounded_pairs(spark, join: Join) -> tuple[Join, DataFrame]:
    """Step 4: pairs of different components that share a prefix shingle and that the bounds let through."""
    folder, bits = join.folder, join.bits
    low, high = np.iinfo(np.int64).min // 2, np.iinfo(np.int64).max // 2

    def extremes(batches):
        sets, bounds = Sets(folder, bits), Bounds(join)
        for batch in batches:
            for b in batch.column("b").to_pylist():
                docs, n, m, shingle, _ = sets.scan(b)
                who, h, inside, need, reach, *_ = bounds.of(docs, n, m, shingle)
                if not len(h):
                    continue
                order = np.argsort(h, kind="stable")
                h, inside, need, reach = h[order], inside[order], need[order], reach[order]
                first = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
                cols = []
                for side in (inside, ~inside):
                    cols += [np.minimum.reduceat(np.where(side, need, high), first), np.maximum.reduceat(np.where(side, reach, low), first)]
                cols.append(np.add.reduceat((~inside).astype(np.int64), first))
                keep = h[first]
                yield packed_batch(by_bucket(keep, bits, *cols))

    def rule(table: pa.Table) -> pa.Table:
        b = table.column("bucket")[0].as_py()
        h, *cols = (np.concatenate(x) for x in arrays_of(table, 6))
        cols = [c.view(np.int64) for c in cols]
        order = np.argsort(h, kind="stable")
        h, cols = h[order], [c[order] for c in cols]
        first = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
        out = [f.reduceat(c, first) for f, c in zip((np.minimum, np.maximum, np.minimum, np.maximum, np.add), cols)]
        some = out[4] > 0  # with all of them in the leader's component there is nothing to find
        for name, x in zip(("rule", "in_need", "in_reach", "out_need", "out_reach", "out_count"), (h[first], *out)):
            save_array(folder, f"{name}-{b}", x[some])
        return done(b)

    join = join._replace(ruled=sorted(r.bucket for r in join.buckets(spark).mapInArrow(extremes, PACKED).groupBy("bucket").applyInArrow(rule, DONE).collect()))

    def send(batches):
        sets, bounds = Sets(folder, bits), Bounds(join)
        rules = SortedFiles(folder, "rule", bits, join.ruled, ["in_need", "in_reach", "out_need", "out_reach", "out_count"])
        for batch in batches:
            for b in batch.column("b").to_pylist():
                docs, n, m, shingle, _ = sets.scan(b)
                who, h, inside, need, reach, *more = bounds.of(docs, n, m, shingle)
                r = rules.find(h)
                with_out = (need <= r["out_reach"]) & (reach >= r["out_need"])
                with_in = (need <= r["in_reach"]) & (reach >= r["in_need"])
                fits = r["found"] & np.where(inside, with_out, with_in | (with_out & (r["out_count"] > 1)))
                at = np.flatnonzero(fits)
                if len(at):
                    w = who[at]
                    yield packed_batch(by_bucket(h[at], bits, docs[w], n[w], bounds.component(docs)[w], inside[at].astype(np.int64), need[at], reach[at], *[x[at] for x in more]))

    def meet(table: pa.Table) -> pa.Table:
        cols = [np.concatenate(x).view(np.int64) for x in arrays_of(table, 9 + len(WORDS))]
        order = np.lexsort((cols[1], cols[4], cols[0]))
        h, doc, n, comp, inside, need, reach, overlap, outside_lead, *lacks = (x[order] for x in cols)
        lacks = np.stack(lacks, axis=1).view(np.uint64)
        lacking = np.bitwise_count(lacks).sum(axis=1).astype(np.int64)
        t = join.percent
        unknown = overlap == UNKNOWN
        shared = np.where(unknown, outside_lead, overlap + outside_lead)
        edges = np.append(np.flatnonzero(np.append(True, h[1:] != h[:-1])), len(h))
        xs, ys = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for s, e in zip(edges, edges[1:]):
            outside = s + int((inside[s:e] == 0).sum())
            for i in range(s, outside):  # each with the outside ones after it and with all inside ones
                rest = slice(i + 1, e)
                at = i + 1 + np.flatnonzero((comp[rest] != comp[i]) & (need[rest] <= reach[i]) & (need[i] <= reach[rest]) & able(n[rest], n[i], t))
                # of what y has of the leader, x also lacks the bits that only x's bitmap has; and the other way round
                either = np.bitwise_count(lacks[at] | lacks[i]).sum(axis=1).astype(np.int64)
                within = np.minimum(overlap[at] - (either - lacking[at]), overlap[i] - (either - lacking[i]))
                most = within + np.minimum(outside_lead[at], outside_lead[i])
                # a bitmap that was never counted says nothing: only the shared parts bound such a pair
                most = np.where(unknown[at] | unknown[i], np.minimum(shared[at], shared[i]), most)
                y = doc[at[(100 + t) * most >= t * (n[at] + n[i])]]
                xs.append(np.minimum(y, doc[i]))
                ys.append(np.maximum(y, doc[i]))
        p = np.unique(np.stack([np.concatenate(xs), np.concatenate(ys)]), axis=1)
        return pa.table({"x": pa.array(p[0], pa.int64()), "y": pa.array(p[1], pa.int64())})

    pairs = join.buckets(spark).mapInArrow(send, PACKED).groupBy("bucket").applyInArrow(meet, "x long, y long").distinct()
    return join, pairs


def join_documents(docs: DataFrame, size: int = 5, percent: int = 80, bucket_bytes: float = 16_000_000) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reached by links), class_id (smallest doc_id with the same set)."""
    texts = id_text(docs).filter("doc_id is not null")
    spark = texts.sparkSession
    amount = total_bytes(texts)
    join = Join(shared_dir(spark, "ngram-join"), bucket_bits(amount, bucket_bytes), percent)

    def sets(batches):
        for held in word_batches(batches, 400_000):
            found = [(s := shingles(text, size), fingerprint(s)) for _, text in held]
            signed = lambda i: pa.array(np.array([f[i] for _, f in found], np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in held], pa.int64()), pa.array([len(s) for s, _ in found], pa.int64()), signed(0), signed(1)], names=["doc_id", "n", "a", "b"])

    rows = materialize(texts.mapInArrow(sets, "doc_id long, n long, a long, b long"), "ngram-sets")
    rows = rows.groupBy("doc_id").agg(F.min(F.struct("a", "b", "n")).alias("s")).select("doc_id", "s.*")
    rows = materialize(rows, "ngram-documents")
    classes = materialize(rows.filter("n > 0").groupBy("a", "b", "n").agg(F.min("doc_id").alias("rep")), "ngram-classes")
    join = store_sets(texts, classes, join, size, amount)
    join, pairs = leader_pairs(spark, join)
    first = materialize(overlaps(pairs.distinct(), join), "ngram-leaders")
    links = linked(first, percent)
    labels = components(links)

    def keys(batches):
        for batch in batches:
            x, y = batch.column("x").to_numpy(), batch.column("y").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(pair_key(x, y).view(np.int64)), *[batch.column(c) for c in ["y", "overlap", *WORDS]]], names=["key", "y", "overlap", *WORDS])

    def nodes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(key_of(batch.column("node").to_numpy()).view(np.int64)), batch.column("component")], names=["key", "component"])

    known = save_rows(first.mapInArrow(keys, "key long, y long, overlap long, m0 long, m1 long, m2 long, m3 long"), join.folder, join.bits, "key",
                      ["y", "overlap", *WORDS], ["known", "known_y", "known_overlap", *[f"known_{w}" for w in WORDS]])
    labelled = save_rows(labels.mapInArrow(nodes, "key long, component long"), join.folder, join.bits, "key", ["component"], ["node", "component"])
    join, pairs = bounded_pairs(spark, join._replace(known=known, labelled=labelled))
    tried = first.select("x", "y").union(first.select("y", "x"))
    second = overlaps(pairs.join(tried, ["x", "y"], "left_anti"), join)
    labels = components(materialize(links.union(linked(second, percent)), "ngram-links"))
    named = classes.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("a", "b", "n", "rep", F.coalesce("component", "rep").alias("component_id"))
    return rows.join(named, ["a", "b", "n"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("rep", "doc_id").alias("class_id"))
