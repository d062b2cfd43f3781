"""E1 (a): all phrases of a gazetteer in a text, by an automaton over words.

The phrases' prefixes, word by word, are the automaton's states. A state is known by the hash of its words (two lanes of 64 bits, the
second one confirms), so the automaton is a sorted array of states with the types that end in each; no links are stored, and a
phrase of n words needs n entries of some 20 bytes at most. All words of a batch of texts step at once: state + next word is hashed
and looked up, and only places that still are in a state go on. A text is read once, whatever the number and length of the phrases,
and no token ever becomes a row.

The states are made and counted in Spark. Up to ``MOST_STATES`` they are sent to the workers as one table; a larger gazetteer is cut
by the first word into parts of that size, the texts pass each part's table once, and the hits are put together by document.

Words are what stands between white space, without punctuation at either end; an empty word stops every phrase. Hits are
(type, start_char, end_char), code points, end exclusive, all overlaps included, in the order of their starts.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textforge._ship import by_value
from textforge.session import materialize

by_value(__name__)

MOST_STATES = 10_000_000
HITS = "array<struct<type:string,start_char:int,end_char:int>>"
STATES = "first long, h1 long, h2 long, type string"
SPAN = pa.struct([("type", pa.string()), ("start_char", pa.int32()), ("end_char", pa.int32())])
WORDS = re.compile(r"\S+")
FACTORS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))


def bare(word: str) -> tuple[int, int]:
    """Where a word without punctuation at its ends begins and ends."""
    a, b = 0, len(word)
    while a < b and not word[a].isalnum():
        a += 1
    while a < b and not word[b - 1].isalnum():
        b -= 1
    return a, b


def word_lanes(word: str, seed: int) -> tuple[int, int]:
    d = xxhash.xxh3_128_intdigest(word.encode("utf-8", "surrogatepass"), seed)
    return d >> 64, d & (2**64 - 1)


def step(state: np.ndarray, word: np.ndarray, lane: int) -> np.ndarray:
    """The state after one more word."""
    h = (state ^ (state >> np.uint64(29))) * FACTORS[lane] + word
    h = (h ^ (h >> np.uint64(32))) * FACTORS[1 - lane]
    return h ^ (h >> np.uint64(31))


class Words(dict):
    """Number of each bare word met, its two lanes, and where it lies in the word."""

    def __init__(self, seed: int):
        super().__init__()
        self.seed, self.lanes, self.places = seed, [(0, 0)], [(0, 0)]  # 0: no word

    def __missing__(self, word: str) -> int:
        a, b = bare(word)
        if b == a:
            number = 0
        else:
            number = len(self.lanes)
            self.lanes.append(word_lanes(word[a:b], self.seed))
            self.places.append((a, b))
        self[word] = number
        return number


def split_texts(texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The words of all texts, one after another; how many each text has; where each begins in its text."""
    parts = [t.split() if t else [] for t in texts]
    flat, counts = list(chain.from_iterable(parts)), np.array([len(p) for p in parts], np.int64)
    sizes = np.fromiter(map(len, flat), np.int64, len(flat))
    run = np.append(0, np.cumsum(sizes + 1))
    first = np.cumsum(counts) - counts
    starts = run[:-1] - np.repeat(run[first], counts)
    # where all that is not words has as many characters as there are gaps, each gap is one; the other texts are searched
    other = run[first + counts] - run[first] - 1 != np.array([len(t) if t else 0 for t in texts], np.int64)
    for i in np.flatnonzero(other & (counts > 0)).tolist():
        starts[first[i] : first[i] + counts[i]] = [m.start() for m in WORDS.finditer(texts[i])]
    return flat, counts, starts


def span_lists(counts: np.ndarray, kinds: np.ndarray, names: list[str], start: np.ndarray, stop: np.ndarray) -> pa.ListArray:
    """Arrow lists of ``counts`` spans each."""
    types = pa.array(names, pa.string()).take(pa.array(kinds, pa.int64()))
    spans = pa.StructArray.from_arrays([types, pa.array(start.astype(np.int32)), pa.array(stop.astype(np.int32))], fields=list(SPAN))
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)).astype(np.int32)), spans)


def places_of(keys: np.ndarray, state: np.ndarray) -> np.ndarray:
    """Where the states would stand among the sorted keys; looked up in order, so that a large table is read once from end to end."""
    order = np.argsort(state)
    out = np.empty(len(state), np.int64)
    out[order] = np.minimum(np.searchsorted(keys, state[order]), len(keys) - 1)
    return out


def hit_lists(texts: list[str | None], table: dict) -> pa.ListArray:
    """The hits of each text. The first word's state is looked up once for each word met, later ones for the places still in a state."""
    flat, counts, starts = split_texts(texts)
    words = Words(table["seed"])
    ids = np.fromiter(map(words.__getitem__, flat), np.int64, len(flat))
    lanes, bares = np.array(words.lanes, np.uint64), np.array(words.places, np.int64)
    keys, check, first = table["keys"], table["check"], table["first"]
    owner = np.repeat(np.arange(len(texts)), counts)
    left = np.cumsum(counts)[owner] - np.arange(len(flat))  # words from here to the end of the text
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # word, number of words, number of the state
    if len(flat) and len(keys):
        state = [step(np.zeros(len(lanes), np.uint64), lanes[:, i], i) for i in (0, 1)]
        place = places_of(keys, state[0])
        alive = (keys[place] == state[0]) & (check[place] == state[1]) & lanes.any(axis=1)
        at = np.flatnonzero(alive[ids])
        place, state = place[ids[at]], [s[ids[at]] for s in state]
        length = 1
        while len(at):
            last = first[place + 1] > first[place]
            found.append((at[last], np.full(int(last.sum()), length), place[last]))
            more = left[at] > length  # no phrase reaches into the next text
            at, state = at[more], [s[more] for s in state]
            if not len(at):
                break
            nxt = lanes[ids[at + length]]
            state = [step(state[i], nxt[:, i], i) for i in (0, 1)]
            length += 1
            place = places_of(keys, state[0])
            alive = (keys[place] == state[0]) & (check[place] == state[1]) & nxt.any(axis=1)
            at, place, state = at[alive], place[alive], [s[alive] for s in state]
    word, size, place = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
    order = np.lexsort((place, size, word))
    word, size, place = word[order], size[order], place[order]
    ending = first[place + 1] - first[place]
    kinds = table["types"][np.arange(ending.sum()) + np.repeat(first[place] - (np.cumsum(ending) - ending), ending)]
    end = word + size - 1
    start, stop = starts[word] + bares[ids[word], 0], starts[end] + bares[ids[end], 1]
    each = np.bincount(np.repeat(owner[word], ending), minlength=len(texts))
    return span_lists(each, kinds, table["names"], np.repeat(start, ending), np.repeat(stop, ending))


def find_hits(texts: list[str | None], table: dict) -> list[list[dict]]:
    """The hits of each text."""
    return hit_lists(texts, table).to_pylist()


def states_of(gazetteer: DataFrame, seed: int) -> DataFrame:
    """Distinct (first, h1, h2, type): a row for each type that ends in a state, with null if none does."""
    def make(batches):
        for batch in batches:
            parts, kinds = [k.split(" ") for k in batch.column("key").to_pylist()], np.array(batch.column("type").to_pylist(), object)
            sizes = np.array([len(p) for p in parts], np.int64)
            begin = np.cumsum(sizes) - sizes
            lanes = np.array([word_lanes(w, seed) for p in parts for w in p], np.uint64).reshape(-1, 2)
            at, state, cols = np.arange(len(parts)), [np.zeros(len(parts), np.uint64)] * 2, []
            for i in range(sizes.max(initial=0)):  # all phrases step at once
                more = sizes[at] > i
                at, state = at[more], [s[more] for s in state]
                state = [step(state[k], lanes[begin[at] + i, k], k) for k in (0, 1)]
                first = state[0].view(np.int64) if i == 0 else first[more]
                cols.append((first, state[0].view(np.int64), state[1].view(np.int64), np.where(sizes[at] == i + 1, kinds[at], None)))
            if cols:
                first, h1, h2, kind = (np.concatenate(c) for c in zip(*cols))
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in (first, h1, h2)), pa.array(kind, pa.string())], names=["first", "h1", "h2", "type"])

    return gazetteer.filter("key <> ''").select("key", "type").mapInArrow(make, STATES).distinct()


def table_of(states: DataFrame, seed: int) -> dict:
    """The sorted arrays of a part's states; no two of them share the first lane."""
    rows = states.select("h1", "h2", "type").toArrow()  # at most MOST_STATES, and one row more for each further type
    h1, h2 = (rows.column(c).to_numpy().astype(np.int64).view(np.uint64) for c in ("h1", "h2"))
    kinds = rows.column("type").combine_chunks().dictionary_encode()
    names = kinds.dictionary.to_pylist()
    kind = kinds.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    order = np.lexsort((kind, h1))
    h1, h2, kind = h1[order], h2[order], kind[order]
    new = np.flatnonzero(np.append(True, h1[1:] != h1[:-1])) if len(h1) else np.zeros(0, np.int64)
    ending = np.add.reduceat((kind >= 0).astype(np.int64), new) if len(h1) else np.zeros(0, np.int64)
    return {"seed": seed, "keys": h1[new], "check": h2[new], "first": np.append(0, np.cumsum(ending)), "types": kind[kind >= 0].astype(np.int32), "names": names}


def hits_udf(spark, table: dict):
    shared = spark.sparkContext.broadcast(table)  # of MOST_STATES states at most
    kind = T.ArrayType(T.StructType([T.StructField("type", T.StringType()), T.StructField("start_char", T.IntegerType()), T.StructField("end_char", T.IntegerType())]))

    def hits(text: pa.Array) -> pa.Array:
        return hit_lists(text.to_pylist(), shared.value)

    hits.__annotations__ = {"text": pa.Array, "return": pa.Array}
    return F.arrow_udf(hits, kind).asNondeterministic()  # only to keep Catalyst from repeating the call in filters


def with_phrases(docs: DataFrame, id_col: str, text_col: str, gazetteer: DataFrame, out_col: str, most_states: int = MOST_STATES) -> DataFrame:
    """docs with ``out_col``: the hits of the gazetteer's phrases (key, type). ``docs`` must be unique on ``id_col``, and written
    if the gazetteer has several parts: each passes over it."""
    spark, seed = docs.sparkSession, 0
    while True:
        seed += 1
        states = materialize(states_of(gazetteer, seed), "phrase-states")
        if states.groupBy("h1").agg(F.min("h2").alias("a"), F.max("h2").alias("b")).filter("a <> b").isEmpty():
            break  # else two states share a lane: 1 in 10^5 for 10 million
    parts = max(1, -(-states.count() // most_states))
    text = F.col(text_col)
    if parts == 1:
        return docs.withColumn(out_col, hits_udf(spark, table_of(states, seed))(text))
    found = None
    for p in range(parts):
        hits = hits_udf(spark, table_of(states.filter(F.pmod("first", F.lit(parts)) == p), seed))
        part = materialize(docs.select(F.col(id_col).alias("_id"), hits(text).alias("h")), "phrase-hits").filter(F.size("h") > 0)
        found = part if found is None else found.union(part)
    by_doc = found.groupBy("_id").agg(F.flatten(F.collect_list("h")).alias(out_col))  # a row for each part at most
    joined = docs.join(by_doc, docs[id_col] == by_doc["_id"], "left").drop("_id")
    return joined.withColumn(out_col, F.coalesce(out_col, F.array().cast(HITS)))
