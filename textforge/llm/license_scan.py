"""License scan by diagonal voting, in DataFrame operations only.

Every document becomes its rolling word k-grams; their hashes are joined with the k-gram hashes of the templates (a small
table of phrases, so the join's build side is bounded by the parameter). A hit at word ``pos`` of k-gram ``tpos`` of a
template votes for the diagonal ``pos - tpos``.

* An exact template ("base") has a place where all its k-grams vote for one diagonal.
* For a fuzzy template of t words, ``edits`` = (1 - threshold) t words may be changed, put in or left out. k is so small
  that every such place has a k-gram without an edit. Around each voted diagonal (``slack`` words, or ``edits`` if more) the
  words are compared: the span is the shortest run of words with the least word edit distance from the template, and scores
  1 - distance / t. Overlapping spans are one place; the best of them stands for it.
* A span must have a word that no other fuzzy template has (if the template has such words): "licensed under the bsd
  license" is one word from the MIT notice, but another licence.

Hits are verified: the words themselves are compared, not only the hashes. Words are the runs of
``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z are lower-cased.

Defined cases: a null or empty text has no words; rows of one doc_id (null included) give one result row, their word and
place counts added; an empty table gives no rows; further columns are ignored. A text of any length is one row's array of words and
k-grams. Ties: of runs with equal edit distance the shorter one is the span, then the one that starts first; equal spans of
different templates all count.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textforge.llm.common import id_text
from textforge.session import materialize

SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # A-Z too are word characters before lower-casing
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Phrase and label of the base scan.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Opening words of public licence notices, found with small changes too.
NOTICES = {
    "licensed under the apache license version 2 0": "apache-notice",
    "licensed under the gnu general public license version 3": "gpl-notice",
    "licensed under cc by nc 4 0": "cc-by-nc-notice",
    "licensed under the mit license": "mit-notice",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files": "mit-text",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the "
    "following conditions are met": "bsd-text",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
    "granted": "isc-text",
    "this source code form is subject to the terms of the mozilla public license": "mpl-notice",
}


def edits_of(words: int, threshold: float) -> int:
    """The most words of a template that may differ."""
    return max(0, math.floor((1 - threshold) * words + 1e-9))


def templates(spark, base: dict[str, str], notices: dict[str, str], threshold: float, slack: int) -> DataFrame:
    """One row per k-gram position: label, exact, n_grams, t_words, edits, reach, k, tpos, gram (its words), phrase, h (gram's hash)."""
    rows = []
    for exact, group in ((True, base), (False, notices)):
        for number, (phrase, label) in enumerate(sorted(group.items())):
            words = [w.lower() for w in re.split(SEPARATORS, phrase) if w]
            edits = 0 if exact else edits_of(len(words), threshold)
            # the words left are at most edits + 1 runs, the longest of which has so many words at least
            k = max(min(1, len(words)), min(3, len(words), -(-(len(words) - edits) // (edits + 1))))
            grams = len(words) - k + 1
            rows += [(2 * number + exact, label, exact, grams, len(words), edits, max(edits, slack), k, t, words[t : t + k], words) for t in range(grams if k else 0)]
    schema = "template int, label string, exact boolean, n_grams int, t_words int, edits int, reach int, k int, tpos int, gram array<string>, phrase array<string>"
    return spark.createDataFrame(rows, schema).withColumn("h", F.xxhash64("gram"))


def kgram_hits(docs: DataFrame, table: DataFrame, ks: list[int]) -> DataFrame:
    """One row for each document (``head``) and for each verified k-gram hit, from a single pass over the texts."""
    most = max(ks)
    words = F.coalesce(F.filter(F.split("text", SEPARATORS), lambda w: w != ""), F.array().cast("array<string>"))
    kept = id_text(docs).select("doc_id", F.monotonically_increasing_id().alias("row"), words.alias("w"))
    ahead = [F.slice("w", i + 1, F.greatest(F.size("w") - i, F.lit(0))).alias(f"w{i}") for i in range(1, most)]
    runs = kept.select("doc_id", "row", "w", F.size("w").cast("long").alias("n_words"), F.posexplode_outer(F.arrays_zip(F.col("w").alias("w0"), *ahead)).alias("pos", "g"))
    given = [F.col(f"g.w{i}").alias(f"w{i}") for i in range(most)]
    # lower() finds at least what lower-casing A-Z alone finds; the comparison of words below is the exact one
    low = [F.lower(f"w{i}") for i in range(most)]
    hashes = [F.struct(F.lit(k).alias("k"), F.when(low[k - 1].isNotNull(), F.xxhash64(F.array(*low[:k]))).alias("h")) for k in ks]
    keyed = runs.select("doc_id", "row", "w", "n_words", "pos", *given).withColumn("kh", F.explode(F.array(*hashes))).select("*", "kh.k", "kh.h").drop("kh")
    # the templates are the operator's own phrases: their number bounds the broadcast
    joined = keyed.join(F.broadcast(table.drop("phrase")), ["k", "h"], "left")
    same = F.col("template").isNotNull()
    for i in range(most):
        same &= (F.col("k") <= i) | (F.translate(f"w{i}", UPPER, LOWER) == F.get("gram", F.lit(i)))
    hit = F.coalesce(same, F.lit(False))
    head = (F.coalesce("pos", F.lit(0)) == 0) & (F.col("k") == ks[0])
    diagonal = F.col("pos") - F.col("tpos")
    low = F.greatest(F.lit(0), diagonal - F.col("reach"))
    around = F.when(F.col("hit") & ~F.col("exact"), F.slice("w", low + 1, diagonal + F.col("t_words") + F.col("reach") - low))
    return joined.withColumn("hit", hit).withColumn("head", head).filter("hit or head").select(
        "doc_id", "row", "n_words", "pos", "head", "hit", "template", "label", "exact", "n_grams", "t_words", "edits", "reach", "tpos",
        low.alias("low"), around.alias("around"))


def aligned(diagonals: DataFrame, table: DataFrame) -> DataFrame:
    """Of each diagonal of a fuzzy template: start, words and dist of the run of words around it that is nearest to the template.

    A word becomes the letter of its place among the template's distinct words, so that ``levenshtein`` compares words."""
    rows, phrases = [], table.filter("not exact").select("template", "phrase").distinct().collect()  # one row for each template
    used = Counter(w for r in phrases for w in set(r.phrase))
    for r in phrases:
        distinct = list(dict.fromkeys(r.phrase))
        letters = "".join(chr(0x4E00 + i) for i in range(len(distinct) + 1))  # the first is that of all other words
        rows.append((r.template, distinct, letters, "".join(letters[1 + distinct.index(w)] for w in r.phrase),
                     "".join(letters[1 + i] for i, w in enumerate(distinct) if used[w] == 1)))
    codes = table.sparkSession.createDataFrame(rows, "template int, known array<string>, letters string, code string, own string")
    known = diagonals.join(F.broadcast(codes), "template")
    letter = lambda w: F.substr("letters", (F.array_position("known", F.translate(w, UPPER, LOWER)) + 1).cast("int"), F.lit(1))
    known = known.withColumn("text", F.array_join(F.transform("around", letter), ""))

    def run(first, words):
        part = F.substr(F.col("text"), first + 1, words)
        return F.struct(F.levenshtein(part, F.col("code")).alias("dist"), F.length(part).alias("words"), (F.col("low") + first).alias("start"), part.alias("part"))

    lengths = F.sequence(F.col("t_words") - F.col("edits"), F.col("t_words") + F.col("edits"))
    runs = F.flatten(F.transform(F.sequence(F.lit(0), 2 * F.col("reach")), lambda i: F.transform(lengths, lambda n: run(i, n))))
    best = known.withColumn("best", F.array_min(runs)).select("doc_id", "row", "template", "label", "exact", "t_words", "edits", "own", "best.*")
    return best.filter((F.col("own") == "") | F.regexp_like("part", F.concat(F.lit("["), "own", F.lit("]"))))


def scan(docs: DataFrame, base: dict[str, str] | None = None, notices: dict[str, str] | None = None, threshold: float = 0.8,
         slack: int = 2) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans (label, start, words, score)."""
    table = templates(docs.sparkSession, BASE if base is None else base, NOTICES if notices is None else notices, threshold, slack)
    ks = sorted({r.k for r in table.select("k").distinct().collect()}) or [1]  # some of 1, 2, 3
    hits = materialize(kgram_hits(docs, table, ks), "license-hits")
    heads = hits.filter("head").groupBy("doc_id", "row").agg(F.max("n_words").alias("n_words"))
    votes = hits.filter("hit").withColumn("diagonal", F.col("pos") - F.col("tpos"))
    by_diagonal = ["doc_id", "row", "template", "label", "exact", "n_grams", "t_words", "edits", "reach", "diagonal"]
    diagonals = votes.groupBy(*by_diagonal).agg(F.collect_set("tpos").alias("matched"), F.first("low").alias("low"), F.first("around").alias("around"))
    places = diagonals.filter("exact and size(matched) = n_grams").select(
        "doc_id", "label", "exact", F.col("diagonal").cast("long").alias("start"), F.col("t_words").alias("words"), F.lit(1.0).alias("score"))
    near = aligned(diagonals.filter("not exact"), table).filter("dist <= edits").withColumn("end", F.col("start") + F.col("words"))
    by = W.partitionBy("doc_id", "row", "template").orderBy("start", "end")
    apart = F.col("start") >= F.max("end").over(by.rowsBetween(W.unboundedPreceding, -1))
    merged = near.withColumn("new", F.coalesce(apart, F.lit(True)).cast("int")).withColumn("span", F.sum("new").over(by.rowsBetween(W.unboundedPreceding, 0)))
    merged = merged.groupBy("doc_id", "row", "template", "label", "exact", "t_words", "span").agg(F.min(F.struct("dist", "words", "start")).alias("best"))
    spans = merged.select("doc_id", "label", "exact", F.col("best.start").cast("long").alias("start"), F.col("best.words").cast("int").alias("words"),
                          ((F.col("t_words") - F.col("best.dist")) / F.col("t_words")).alias("score"))
    start = F.when(F.col("exact"), F.col("start"))
    labels = lambda c: F.concat_ws(",", F.sort_array(F.collect_set(c)))
    span = F.when(F.col("label").isNotNull(), F.struct("label", "start", "words", "score"))
    return heads.select("doc_id", "n_words").unionByName(places.unionByName(spans), allowMissingColumns=True).groupBy("doc_id").agg(
        F.sum("n_words").alias("n_words"),
        F.count(start).alias("n_base"),
        F.min(start).alias("first_word"),
        F.max(start).alias("last_word"),
        labels(F.when(F.col("exact"), F.col("label"))).alias("base_labels"),
        labels("label").alias("labels"),
        F.coalesce(F.max("score"), F.lit(0.0)).alias("score"),
        F.sort_array(F.collect_list(span)).alias("spans"))
