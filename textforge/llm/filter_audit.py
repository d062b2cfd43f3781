"""Filter interaction audit by higher-order SQL folds.

Five filters, applied in every one of the 120 orders: how much does each step remove, how much of that had been removed by
an earlier step, what does a filter remove that no other would, and what good or toxic documents are lost where?

Which filters a document fails is one mask of five bits, independent of any order, so the documents are counted once: one
cell for each part and mask, at most 32 of them in a part whatever the size of the corpus. Each cell then folds across the
array of the orders: ``transform`` over the orders, and within an order ``aggregate`` over its letters, which carries the
set of filters already applied. That makes 600 structs (120 orders, 5 steps) for each cell, weighted by its counts. The
cells' arrays of a part are merged by elementwise sums, and a last fold gives each filter's removals over all orders.

Everything is DataFrame functions; the texts are read once and only masks, ids and digests are written and joined.

Filter E (identical to the text of a smaller doc_id) needs no window over copies: the smallest doc_id of each text is an
aggregate with partial sums, and a document passes if the pair (digest, doc_id) is among them. That join's key differs for
each copy, so a text with a third of all rows spreads over all tasks. Texts are told apart by SHA-256.

Defined cases: a null text is empty; an empty text has no words (fails A, passes B, C and D). A null ``source`` is the part
``''``, as an empty one. A row without doc_id has no smaller or larger one: it passes E and is nobody's original. Repeated
rows (same doc_id, same text) are all counted and are not copies of each other. A document without labels is neither good
nor toxic; labels repeated for a doc_id count once, and as 1 if any of them is 1. No documents: no parts, no rows. Texts
of any length are taken whole, as one row's string and array of words. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textforge.session import materialize

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
SPACE = r"[\x20\x09-\x0D]+"


def with_failures(rows: DataFrame, least_words: int = 50, least_distinct: int = 65, most_capitals: int = 5) -> DataFrame:
    """Rows with a text ``t`` (not null), and ``mask``: the bits of the filters A to D that it fails.

    The words are a column of their own below the counts, so that each text is split once."""
    split = rows.withColumn("words", F.split(F.btrim("t", F.lit(" \t\n\x0b\f\r")), SPACE))
    counted = split.withColumn("n", F.when(F.element_at("words", 1) == "", F.lit(0)).otherwise(F.size("words"))).withColumn("n_distinct", F.size(F.array_distinct("words")))
    n = F.col("n").cast("long")
    fails = [
        n < least_words,
        100 * F.col("n_distinct").cast("long") < least_distinct * n,
        100 * F.octet_length(F.regexp_replace("t", r"[^A-Z]+", "")).cast("long") > most_capitals * F.length("t").cast("long"),
        F.col("t").rlike(r"[#$%&*|]"),
    ]
    return counted.withColumn("mask", sum((f.cast("int") * (1 << i) for i, f in enumerate(fails)), F.lit(0))).drop("words", "n", "n_distinct")


def document_masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask (bit i: the filter FILTERS[i] fails), good and toxic (0 or 1) of every document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.alias("t"))
    rows = materialize(with_failures(rows).select("doc_id", "part", "mask", F.unhex(F.sha2("t", 256)).alias("digest")), "audit-masks")
    first = rows.filter("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("is_first", F.lit(True))
    marks = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        *[F.max(F.coalesce((F.col(label) == 1).cast("int"), F.lit(0))).alias(name) for label, name in (("quality", "good"), ("toxic", "toxic"))])
    copy = F.col("doc_id").isNotNull() & F.col("is_first").isNull()
    return (rows.join(first, ["digest", "doc_id"], "left").join(marks, "doc_id", "left")
            .select("part", (F.col("mask") + copy.cast("int") * 16).alias("mask"), F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")))


def fold_orders(mask: Column, n: Column, good: Column, toxic: Column) -> Column:
    """The 600 structs of one mask cell: for each order a fold over its letters that carries the filters already applied."""
    zero = F.lit(0).cast("long")

    def bit(letter: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1), F.ascii(letter) - ord("A"))

    def step(order: Column, state: Column, letter: Column) -> Column:
        fails = mask.bitwiseAND(bit(letter)) != 0
        gone = mask.bitwiseAND(state["before"]) != 0
        here = fails & ~gone
        row = F.struct(
            order.alias("filter_order"),
            (F.size(state["steps"]) + 1).alias("step"),
            letter.alias("letter"),
            F.when(~fails & ~gone, n).otherwise(zero).alias("kept"),
            F.when(here, n).otherwise(zero).alias("removed"),
            F.when(fails & gone, n).otherwise(zero).alias("redundant"),
            F.when(mask == bit(letter), n).otherwise(zero).alias("unique_fails"),
            F.when(here, good).otherwise(zero).alias("good_lost"),
            F.when(here, toxic).otherwise(zero).alias("toxic_lost"),
        )
        return F.struct((state["before"].bitwiseOR(bit(letter))).alias("before"), F.concat(state["steps"], F.array(row)).alias("steps"))

    kind = "array<struct<filter_order:string,step:int,letter:string," + ",".join(f"{c}:bigint" for c in COUNTS) + ">>"
    start = F.struct(F.lit(0).alias("before"), F.array().cast(kind).alias("steps"))
    orders = F.array(*[F.lit(o) for o in ORDERS])
    return F.flatten(F.transform(orders, lambda o: F.aggregate(F.split(o, ""), start, lambda state, letter: step(o, state, letter), lambda state: state["steps"])))


def merged(arrays: Column) -> Column:
    """Elementwise sums of the cells' arrays; all list the orders and steps alike."""
    def add(x: Column, y: Column) -> Column:
        return F.struct(x["filter_order"].alias("filter_order"), x["step"].alias("step"), x["letter"].alias("letter"), *[(x[c] + y[c]).alias(c) for c in COUNTS])

    return F.aggregate(F.slice(arrays, 2, 32), F.element_at(arrays, 1), lambda acc, cell: F.zip_with(acc, cell, add))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, filter_order and step with the counts of ``COUNTS`` and ``shapley``."""
    cells = document_masks(docs, labels).groupBy("part", "mask").agg(F.count("*").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
    folded = cells.select("part", fold_orders(F.col("mask"), F.col("n"), F.col("good"), F.col("toxic")).alias("steps"))
    cells = folded.groupBy("part").agg(F.collect_list("steps").alias("cells"))  # 32 at most

    def removals(steps: Column) -> Column:
        return F.transform(F.array(*[F.lit(f) for f in FILTERS]), lambda f: F.aggregate(
            F.filter(steps, lambda s: s["letter"] == f), F.lit(0).cast("long"), lambda a, s: a + s["removed"]))

    # inside the lambda the merged array is a value; as a column of its own it would be merged anew wherever it is used
    both = F.transform(F.array(merged(F.col("cells"))), lambda steps: F.struct(steps.alias("steps"), removals(steps).alias("totals")))
    rows = cells.select("part", F.inline(both)).select("part", "totals", F.inline("steps"))
    return rows.select("part", "filter_order", "step", *COUNTS, F.element_at("totals", F.ascii("letter") - (ord("A") - 1)).alias("shapley"))
