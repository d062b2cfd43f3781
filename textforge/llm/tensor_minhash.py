"""MinHash near-dedup by tensored banding.

A document's set is its distinct shingles of ``size`` words; two documents link when their sets' Jaccard similarity is
``percent`` / 100 or more. Banding needs many tables, each keyed by several minhashes. Here the tables' keys are not drawn
one by one: a document has ``collections`` small collections of ``rows`` minhashes each, and every pair of collections
makes the key of one table (2 * ``rows`` minhashes). The defaults compute 20 * 4 = 80 minhashes for 190 tables, which banding
would need 1520 for. Two documents with Jaccard J agree in a collection with J ** rows, and meet in a table as soon as they agree
in two collections: at J = 0.85 all but 9 in a million pairs do, at 0.9 all but 3 in a hundred million.

1. Equal sets are one class (two 64-bit halves of a fingerprint), represented by its smallest doc_id.
2. A collection's value that only one document has cannot make two keys equal. So the values are counted first (plain rows,
   partial sums) and only pairs of values that several documents have become keys: documents without a near copy make none.
3. Documents that link have sizes in the same or in neighbouring classes, which are powers of 100 / percent. Each table key
   and size class with its neighbour names one leader, the document whose values most others share; every document is paired
   with the leaders of its keys, not with all others.
4. Every document's overlap with its most shared leader is counted on the full sets. Links make the first components. A
   leader whose followers all lie in one component has nothing more to tell. For the others the rest of the overlaps is counted,
   with two bitmaps: of what the follower lacks of the leader, and of what it has beside it.
5. Followers of one leader in different components could still link. If x and y lack different parts of the leader, or have
   different things beside it, they share no more than the rest: the bitmaps bound their overlap from above. The condition is
   part of the join, so only pairs that may link leave it, and these too are counted on their full sets.

So no group is expanded into its pairs, and a link is only missed if two documents agree in less than two collections. What
step 5 compares (not what it makes) still grows with the followers of one leader that lie outside its component.

Defined cases: A-Z are lower-cased, words are cut at ``\\x20\\x09-\\x0D``; a text of fewer words than ``size`` has the whole
sequence as its only shingle; a null text, or one without words, has an empty set and links with nothing; documents without a
doc_id are left out; of rows that repeat a doc_id the one with the smallest fingerprint counts, so the result has each doc_id
once; equal priorities of leaders go to the smaller doc_id; an empty table gives no rows; further columns are ignored. A text
of any length is taken whole: its words, shingles and set are arrays of one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textforge._ship import by_value
from textforge.llm.common import id_text, mix, rolling, small_side, word_batches, word_hashes
from textforge.llm.components import components
from textforge.session import materialize

by_value(__name__)

BITMAP = 4  # longs


def shingle_set(text: bytes, size: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    h = word_hashes(text.lower().split())
    if len(h) <= size:
        return rolling(h, len(h)) + np.uint64(len(h)) if len(h) else h
    return np.unique(rolling(h, size))


def halves(s: np.ndarray) -> tuple[int, int]:
    d = xxhash.xxh3_128_intdigest(s.tobytes())
    return d >> 64, d & (2**64 - 1)


def signed(values) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def collection_values(sets: list[np.ndarray], collections: int, rows: int) -> np.ndarray:
    """One 64-bit value for each set (not empty) and collection: its ``rows`` minhashes, mixed with the collection's number."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    factors = np.random.default_rng(17).integers(1 << 62, 1 << 63, collections * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.empty((len(sets), collections), np.uint64)
    for c in range(collections):
        value = np.full(len(sets), c + 1, np.uint64)
        for r in range(rows):
            # hashes are random 64-bit numbers: an odd factor gives them a new order
            value = mix(value * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat(flat * factors[c * rows + r], starts))
        out[:, c] = value
    return out


def signatures(texts: DataFrame, size: int, collections: int, rows: int) -> DataFrame:
    """doc_id, n, a, b (fingerprint of the set) and the values of its collections."""
    def sign(batches):
        for held in word_batches(batches, 400_000):
            sets = [shingle_set(text, size) for _, text in held]
            full = [i for i, s in enumerate(sets) if len(s)]
            values = np.zeros((len(sets), collections), np.uint64)
            if full:
                values[full] = collection_values([sets[i] for i in full], collections, rows)
            prints = [halves(s) for s in sets]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, collections, dtype=np.int32)), signed(values.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in held], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), signed([p[0] for p in prints]), signed([p[1] for p in prints]), lists],
                                             names=["doc_id", "n", "a", "b", "vals"])

    return texts.mapInArrow(sign, "doc_id long, n long, a long, b long, vals array<long>")


def shared_values(reps: DataFrame, collections: int) -> DataFrame:
    """doc_id, n, weight (how many others share its values) and live: (collection, value) of the values that several documents have."""
    each = reps.select("doc_id", F.posexplode("vals").alias("c", "v"))
    counts = each.groupBy("v").agg(F.count("*").alias("many")).filter("many > 1")
    live = each.join(counts, "v").groupBy("doc_id").agg(F.sum("many").alias("weight"), F.array_sort(F.collect_list(F.struct("c", "v"))).alias("live"))  # one for each collection at most
    return live.filter(F.size("live") > 1).join(reps.select("doc_id", "n"), "doc_id")


def table_keys(live: DataFrame, percent: int) -> DataFrame:
    """A row for each table whose two values are shared, twice: for the document's size class and the next."""
    pairs = F.flatten(F.transform("live", lambda x, i: F.transform(F.slice(F.col("live"), i + 2, F.size("live")), lambda y: F.xxhash64(x["v"], y["v"]))))
    kind = F.floor(F.log(F.col("n").cast("double")) / float(np.log(100 / percent))).cast("int")
    return live.select("doc_id", "weight", kind.alias("kind"), F.explode(pairs).alias("key")).select(
        "doc_id", "weight", "key", F.explode(F.array("kind", F.col("kind") + 1)).alias("kind"))


def followers(keys: DataFrame) -> DataFrame:
    """Distinct (x, z): a document and a leader of one of its keys; weight is the leader's."""
    first = keys.groupBy("key", "kind").agg(F.max(F.struct("weight", (-F.col("doc_id")).alias("minus"))).alias("top"), F.count("*").alias("many")).filter("many > 1")
    first = first.select("key", "kind", (-F.col("top.minus")).alias("z"), F.col("top.weight").alias("lead"))
    return keys.join(first, ["key", "kind"]).groupBy(F.col("doc_id").alias("x"), "z").agg(F.max("lead").alias("lead"))


def bitmap(values: Column) -> Column:
    """Which of 256 cells the hashes fall into, as four longs."""
    start = F.array(*[F.lit(0).cast("long") for _ in range(BITMAP)])

    def put(bits: Column, h: Column) -> Column:
        word, bit = F.shiftrightunsigned(h, 62), F.shiftrightunsigned(h, 56).cast("int").bitwiseAND(63)
        one = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
        return F.transform(bits, lambda b, i: F.when(i.cast("long") == word, b.bitwiseOR(one)).otherwise(b))

    return F.aggregate(values, start, put)


class Sets:
    """The full sets of the documents that some pair needs, built from their texts and written once for each round."""

    def __init__(self, texts: DataFrame, reps: DataFrame, size: int):
        self.texts, self.reps, self.size = texts, reps.select("doc_id", "a", "b"), size

    def of(self, pairs: DataFrame) -> DataFrame:
        """doc_id, n, s (array of shingle hashes) of the documents in ``pairs`` (x, z)."""
        size = self.size
        wanted = materialize(pairs.select(F.explode(F.array("x", "z")).alias("doc_id")).distinct().join(self.reps, "doc_id"), "tensor-wanted")
        texts = self.texts.join(small_side(wanted.select("doc_id"), wanted.count()), "doc_id", "left_semi")

        def build(batches):
            for held in word_batches(batches, 400_000):
                sets = [shingle_set(text, size) for _, text in held]
                prints = [halves(s) for s in sets]
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0] + [len(s) for s in sets]), pa.int32()), signed(np.concatenate(sets)))
                yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in held], pa.int64()), signed([p[0] for p in prints]), signed([p[1] for p in prints]), lists], names=["doc_id", "a", "b", "s"])

        made = texts.mapInArrow(build, "doc_id long, a long, b long, s array<long>")
        # rows that repeat a doc_id: its representative's set, once
        return materialize(made.join(wanted, ["doc_id", "a", "b"], "left_semi").dropDuplicates(["doc_id"]).select("doc_id", "s"), "tensor-sets")

    def overlaps(self, pairs: DataFrame, name: str, with_bitmaps: bool = False) -> DataFrame:
        """x, z, nx, nz, overlap of pairs (x, z), counted on the full sets; the bitmaps of z without x and x without z."""
        pairs = materialize(pairs, f"{name}-pairs")
        sets = self.of(pairs)
        both = pairs.join(sets.select(F.col("doc_id").alias("x"), F.col("s").alias("sx")), "x").join(sets.select(F.col("doc_id").alias("z"), F.col("s").alias("sz")), "z")
        counts = [F.size("sx").cast("long").alias("nx"), F.size("sz").cast("long").alias("nz"), F.size(F.array_intersect("sx", "sz")).cast("long").alias("overlap")]
        if with_bitmaps:
            counts += [bitmap(F.array_except("sz", "sx")).alias("lacks"), bitmap(F.array_except("sx", "sz")).alias("beside")]
        return materialize(both.select("x", "z", *counts), name)


def links(counted: DataFrame, percent: int) -> DataFrame:
    ok = 100 * F.col("overlap") >= percent * (F.col("nx") + F.col("nz") - F.col("overlap"))
    return counted.filter(ok & (F.col("x") != F.col("z"))).select(F.col("x").alias("a"), F.col("z").alias("b"))


def open_leaders(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs (x, z) with the component of x, of those leaders z whose followers lie in several components."""
    named = pairs.join(labels.withColumnRenamed("node", "x"), "x", "left").withColumn("component", F.coalesce("component", "x"))
    mixed = named.groupBy("z").agg(F.min("component").alias("least"), F.max("component").alias("most")).filter("least < most").select("z")
    return named.join(mixed, "z", "left_semi")


def only_in(x: Column, y: Column) -> Column:
    """How many cells only the first bitmap has."""
    return sum((F.bit_count(F.element_at(x, i).bitwiseAND(F.bitwise_not(F.element_at(y, i)))) for i in range(2, BITMAP + 1)),
               F.bit_count(F.element_at(x, 1).bitwiseAND(F.bitwise_not(F.element_at(y, 1))))).cast("long")


def bounded_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Pairs of followers of one leader in different components that the bitmaps let through.

    members: x, z, nx, overlap, lacks, beside, component. Of the leader's shingles that x has, y lacks those in cells
    that only y's bitmap of lacks has, and the same the other way; beside the leader they share at most what either has
    there without the cells that only its own bitmap has."""
    left = members.select("z", *[F.col(c).alias(f"{c}_1") for c in members.columns if c != "z"]).filter("outside_1")
    right = members.select("z", *[F.col(c).alias(f"{c}_2") for c in members.columns if c != "z"])
    c = {k: F.col(k) for k in left.columns + right.columns}
    inside = F.least(c["overlap_1"] - only_in(c["lacks_2"], c["lacks_1"]), c["overlap_2"] - only_in(c["lacks_1"], c["lacks_2"]))
    beside = F.least(c["nx_1"] - c["overlap_1"] - only_in(c["beside_1"], c["beside_2"]), c["nx_2"] - c["overlap_2"] - only_in(c["beside_2"], c["beside_1"]))
    sizes = (100 * c["nx_1"] >= percent * c["nx_2"]) & (100 * c["nx_2"] >= percent * c["nx_1"])
    once = ~c["outside_2"] | (c["x_1"] < c["x_2"])  # two outside documents meet both ways
    able = (100 + percent) * (inside + beside) >= percent * (c["nx_1"] + c["nx_2"])
    met = left.join(right, (left["z"] == right["z"]) & (c["component_1"] != c["component_2"]) & once & sizes & able)
    return met.select(F.least("x_1", "x_2").alias("x"), F.greatest("x_1", "x_2").alias("z")).distinct()


def near_dedup(docs: DataFrame, size: int = 3, percent: int = 85, collections: int = 20, rows: int = 4) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reached by links), kept (doc_id = component_id), class_id."""
    texts = id_text(docs).filter("doc_id is not null")
    signed_rows = materialize(signatures(texts, size, collections, rows), "tensor-signatures")
    ids = signed_rows.groupBy("doc_id").agg(F.min(F.struct("a", "b", "n")).alias("s")).select("doc_id", "s.*")
    ids = materialize(ids, "tensor-documents")
    classes = materialize(ids.filter("n > 0").groupBy("a", "b", "n").agg(F.min("doc_id").alias("doc_id")), "tensor-classes")
    reps = signed_rows.join(classes, ["doc_id", "a", "b", "n"], "left_semi").dropDuplicates(["doc_id"])
    live = materialize(shared_values(reps, collections), "tensor-live")
    pairs = materialize(followers(table_keys(live, percent)), "tensor-followers")
    sets = Sets(texts, classes, size)
    nearest = pairs.filter("x <> z").groupBy("x").agg(F.max(F.struct("lead", (-F.col("z")).alias("minus"))).alias("top")).select("x", (-F.col("top.minus")).alias("z"))
    found = links(sets.overlaps(nearest, "tensor-nearest"), percent)
    labels = components(found)
    members = materialize(open_leaders(pairs.select("x", "z"), labels), "tensor-open")
    counted = sets.overlaps(members.select("x", "z"), "tensor-members", with_bitmaps=True)
    found = materialize(found.union(links(counted, percent)).distinct(), "tensor-links")
    labels = components(found)
    still = open_leaders(counted, labels)
    lead = labels.select(F.col("node").alias("z"), F.col("component").alias("lead"))
    still = still.join(lead, "z", "left").withColumn("outside", F.col("component") != F.coalesce("lead", "z")).drop("lead", "nz")
    more = links(sets.overlaps(bounded_pairs(materialize(still, "tensor-outside"), percent), "tensor-bounded"), percent)
    labels = components(materialize(found.union(more), "tensor-all-links"))
    named = classes.withColumnRenamed("doc_id", "rep").join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("a", "b", "n", "rep", F.coalesce("component", "rep").alias("component_id"))
    out = ids.join(named, ["a", "b", "n"], "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), (F.col("doc_id") == component).alias("kept"), F.coalesce("rep", "doc_id").alias("class_id"))
