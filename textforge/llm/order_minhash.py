"""Document fingerprints by order MinHash, in DataFrame operations only.

A text's k-mers are its runs of two words (the last word stands alone); equal k-mers are told apart by the number of their
occurrence. A hash of k-mer and number puts each into one of ``buckets`` (its leading bits: one permutation instead of
one hash function for each component). Of every bucket the ``tuple_size`` k-mers with the least hashes are kept, put
back into the order in which they stand in the text, and the tuple is hashed. Two texts agree in a component when they
share these k-mers in the same order, so likeness follows the edit distance and not only the set of words.

Everything is array functions within a row: nothing is exploded or shuffled for a fingerprint. A fingerprint is an array
of ints, the bucket in the leading bits and the tuple's hash in the rest; an empty bucket has none.

Defined cases: a null text is empty; a text without words has an empty fingerprint, which is like another empty one
(1.0) and unlike all others (0.0). ``with_next`` leaves rows without a doc_id out, puts rows that repeat a doc_id next to
each other (ordered by text), takes the only row as its own next, and works on an empty table. Further columns are ignored. A text
of any length is one row's array of k-mers. Equal k-mers are told apart by the number of their occurrence; numbered k-mers with
equal hashes keep the order of the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textforge.llm.common import id_text

SPACE = " \t\n\x0b\x0c\r"


def with_fingerprint(df: DataFrame, text: str, out: str, bits: int = 6, tuple_size: int = 2) -> DataFrame:
    """``df`` with the fingerprint of column ``text`` as ``out``, of 2**bits buckets.

    Each step is a projection of its own whose array the next one uses more than once, so that Catalyst keeps it as a
    column and lambdas look elements up instead of computing the array again.
    """
    keep = [F.col(c) for c in df.columns]
    t, w, s, r, u, v = (f"__{out}_{x}" for x in "twsruv")
    bare = F.btrim(F.col(text), F.lit(SPACE))
    df = df.select(*keep, F.when(bare != "", F.split(bare, "[ \t-\r]+")).otherwise(F.array().cast("array<string>")).alias(w))
    pairs = F.zip_with(w, F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))), lambda a, b: F.xxhash64(a, b))
    numbered = F.sort_array(F.transform(pairs, lambda h, p: F.struct(h.alias("h"), p.alias("p"))))
    df = df.select(*keep, numbered.alias(s))
    # first places of runs of equal k-mers, then the number of each occurrence within its run
    first = F.filter(F.transform(s, lambda x, i: F.when((i == 0) | (F.get(s, i - 1)["h"] != x["h"]), i)), lambda i: i.isNotNull())
    df = df.select(*keep, s, first.alias(r))
    number = F.flatten(F.transform(r, lambda b, i: F.sequence(F.lit(0), F.coalesce(F.get(r, i + 1), F.size(s)) - b - 1)))
    hashed = F.sort_array(F.zip_with(s, number, lambda x, n: F.struct(F.xxhash64(x["h"], n).alias("h"), x["p"].alias("p"))))
    df = df.select(*keep, hashed.alias(u))
    bucket = lambda h: F.shiftrightunsigned(h, 64 - bits)
    least = F.filter(u, lambda x, i: (i < tuple_size) | (bucket(F.get(u, i - tuple_size)["h"]) != bucket(x["h"])))
    ordered = F.sort_array(F.transform(least, lambda x: F.struct(bucket(x["h"]).cast("int").alias("b"), x["p"].alias("p"), x["h"].alias("h"))))
    df = df.select(*keep, ordered.alias(v))

    def component(x: Column, i: Column) -> Column:
        tuple_ = [x["h"]] + [F.when(F.get(v, i + n)["b"] == x["b"], F.get(v, i + n)["h"]) for n in range(1, tuple_size)]
        packed = F.shiftleft(x["b"], 32 - bits).bitwiseOR(F.shiftrightunsigned(F.xxhash64(*tuple_), 32 + bits).cast("int"))
        return F.when((i == 0) | (F.get(v, i - 1)["b"] != x["b"]), packed)

    return df.select(*keep, F.filter(F.transform(v, component), lambda c: c.isNotNull()).alias(out))


def likeness(a: str, b: str, bits: int = 6) -> Column:
    """Share of the components that are equal, of the buckets that either has; 1 for two empty fingerprints."""
    bucket = lambda c: F.transform(c, lambda x: F.shiftrightunsigned(x, 32 - bits))
    either = F.size(F.array_union(bucket(a), bucket(b)))
    return F.when(either == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / either)


def as_text(fingerprint: str) -> Column:
    return F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")), "")


def in_ranges(rows: DataFrame) -> DataFrame:
    """``rows`` (doc_id, text) in ranges of ids (``place``), each with a ``copy`` of the row before it.

    The ids are cut at quantiles into as many ranges as the session has shuffle partitions, so that a window sees one
    range. The row that a range needs from its neighbour is copied into it; there is one such id for each range.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = rows.select("doc_id")
    cuts = sorted({int(x) for x in ids.approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.1 / parts)}) if parts > 1 else []
    place = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]).cast("array<long>"), lambda c: c <= F.col("doc_id")))
    ends = ids.groupBy(place.alias("place")).agg(F.max("doc_id").alias("high")).orderBy("place").collect()  # a row for each range
    lent = [(ends[i - 1].high, r.place) for i, r in enumerate(ends)]
    lent = F.broadcast(spark.createDataFrame(lent, "doc_id long, place int"))
    placed = rows.withColumn("place", place).withColumn("copy", F.lit(False))
    return placed.union(rows.join(lent, "doc_id").select(*rows.columns, "place").withColumn("copy", F.lit(True)))


def with_next(placed: DataFrame, columns: list[str]) -> DataFrame:
    """``next_*`` of the next row by descending doc_id; after the last comes the first."""
    by = W.partitionBy("place").orderBy(F.col("copy").desc(), "doc_id", "text")
    for c in columns:
        placed = placed.withColumn(f"next_{c}", F.lag(c).over(by))
    return placed.filter("not copy").drop("copy", "place")


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last third replaced by the start of the next document (by descending doc_id)."""
    rows = id_text(docs).filter("doc_id is not null").withColumn("text", F.coalesce("text", F.lit("")))
    rows = with_next(with_fingerprint(in_ranges(rows), "text", "fp"), ["text", "fp"])
    rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    third = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(F.left("text", F.length("text") - third), F.left("next_text", third))
    rows = rows.select("doc_id", "n_chars", "fp", "next_fp", edited.alias("edited"))
    rows = with_fingerprint(rows, "edited", "efp")
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), as_text("fp").alias("fingerprint"), as_text("efp").alias("edited_fingerprint"),
        likeness("fp", "efp").alias("near_edited"), likeness("fp", "next_fp").alias("near_next"))
