"""E1 (c): a trained model for entities that no gazetteer lists.

An averaged structured perceptron: every word has one label (O, or the begin or inside of an entity type); features are hashed words,
shapes, affixes and the neighbours' words and shapes; Viterbi decoding finds the best sequence under learned transitions, in which an
inside label can only follow its own entity.

Training is by iterative parameter mixing over all labelled texts. They are written once as numbers, a row for each batch (the features
of each word met, the words' numbers, their labels), in shards of about ``SHARD`` texts. In each round every shard starts from the mixed
weights, makes one pass of perceptron updates, batch by batch, and returns its weights at the end and their mean over the pass; Spark sums
these by blocks. The shards' ends are mixed for the next round, and the means of all shards and rounds are the model. A task holds the
model and one batch of texts, and what reaches the driver has the size of the model, whatever the number of texts.

Prediction is an Arrow function with the model as a broadcast of fixed size; all texts of a batch are decoded at once.
Words are what stands between white space; an entity begins and ends without the punctuation around its words.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textforge._ship import by_value
from textforge.operators.phrases import WORDS, bare, span_lists, split_texts
from textforge.session import materialize

by_value(__name__)

SHAPES = [(re.compile("[A-Z]+"), "X"), (re.compile("[a-z]+"), "x"), (re.compile("[0-9]+"), "0")]
# (offset, which hash of the word there)
TEMPLATE = [(0, 0), (0, 1), (0, 2), (0, 3), (0, 4), (-1, 0), (1, 0), (-1, 1), (1, 1), (-2, 1), (2, 1)]
OFFSETS = np.array([o for o, _ in TEMPLATE])
PAD = 2
BLOCKS = 16
NEVER = -1e9


# ---------------------------------------------------------------- words and features
def word_hashes(word: str) -> tuple[int, ...]:
    """Lower-cased word, shape, prefix, suffix, punctuation around it."""
    a, b = bare(word)
    core, shape = word[a:b], word
    for pattern, mark in SHAPES:
        shape = pattern.sub(mark, shape)
    low = core.lower()
    return tuple(xxhash.xxh3_64_intdigest(x.encode("utf-8", "surrogatepass"), i) for i, x in enumerate((low, shape, low[:3], low[-3:], word[:a] + " " + word[b:])))


class Encoder(dict):
    """Number of each word met; 0 stands for what is beside a text."""

    def __init__(self, bits: int):
        super().__init__()
        self.bits, self.hashes, self.places = bits, [(1, 2, 3, 4, 5)], [(0, 0)]

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self.hashes)
        self.hashes.append(word_hashes(word))
        self.places.append(bare(word))
        return number

    def numbers(self, i: int, which: np.ndarray) -> np.ndarray:
        """Feature numbers that hashes have at place ``i`` of the template."""
        h = (which + np.uint64(i)) * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    def features(self, texts: list[list[str]]) -> np.ndarray:
        """Feature numbers (words, template) of the words of all texts, one after another."""
        ids, places = [], []
        for words in texts:
            ids += [0] * PAD
            places.append(len(ids) + np.arange(len(words)))
            ids += [self[w] for w in words] + [0] * PAD
        at = np.concatenate(places) if places else np.zeros(0, np.int64)
        table, ids = np.array(self.hashes, np.uint64), np.array(ids, np.int64)
        out = np.empty((len(at), len(TEMPLATE)), np.int64)
        for i, (offset, which) in enumerate(TEMPLATE):
            out[:, i] = self.numbers(i, table[ids[at + offset], which])
        return out

    def table(self) -> np.ndarray:
        """Feature numbers (words met, template) that each word gives to the places that it stands at or beside."""
        hashes = np.array(self.hashes, np.uint64)
        return np.stack([self.numbers(i, hashes[:, which]) for i, (_, which) in enumerate(TEMPLATE)], axis=1)


def with_pads(ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words' numbers with 0 beside each text (``counts`` words each), and where the words are."""
    at = np.arange(len(ids)) + np.repeat(np.arange(len(counts)), counts) * 2 * PAD + PAD
    beside = np.zeros(len(ids) + len(counts) * 2 * PAD, np.int64)
    beside[at] = ids
    return beside, at


def scores(table: np.ndarray, beside: np.ndarray, at: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Sums of the weights of the features of the words at ``at``. Of many words, what a word gives to itself and to its neighbours is
    summed once for each word met; the sums are the same either way."""
    out = np.zeros((len(at), weights.shape[1]))
    for offset in sorted({o for o, _ in TEMPLATE}):
        words = beside[at + offset]
        rows = table if len(at) > len(table) else table[words]
        given = np.zeros((len(rows), weights.shape[1]))
        for i, (o, _) in enumerate(TEMPLATE):
            if o == offset:
                given += np.take(weights, rows[:, i], axis=0)
        out += np.take(given, words, axis=0) if len(at) > len(table) else given
    return out


def label_names(types: list[str]) -> list[str]:
    return ["O"] + [f"{x}-{t}" for t in types for x in "BI"]


def allowed(names: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """0 where a label may follow another (or begin), NEVER elsewhere."""
    inside = np.array([n[0] == "I" for n in names])
    same = np.array([[b[0] != "I" or a[2:] == b[2:] and a != "O" for b in names] for a in names])
    return np.where(same, 0.0, NEVER), np.where(inside, NEVER, 0.0)


def viterbi(emit: np.ndarray, lengths: np.ndarray, trans: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Best labels of the words of a ragged batch; step t works on all sequences longer than t at once. Ties: the first label."""
    full = np.flatnonzero(lengths > 0)
    rank = full[np.argsort(-lengths[full], kind="stable")]
    sizes = lengths[rank]
    begin = (np.cumsum(lengths) - lengths)[rank]
    out = np.zeros(len(emit), np.int64)
    if not len(rank):
        return out
    active = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), side="right")
    emit = np.ascontiguousarray(emit.T)
    now = emit[:, begin] + start[:, None]
    were = []  # the scores of each step: the way back looks up where the best ones came from
    finals = np.zeros((len(emit), len(rank)))
    way = np.empty((len(emit), len(emit), len(rank)))
    for t in range(1, len(active) + 1):
        a = active[t] if t < len(active) else 0
        finals[:, a : now.shape[1]] = now[:, a:]
        if not a:
            break
        were.append(now[:, :a])
        now = np.add(were[-1][:, None, :], trans[:, :, None], out=way[:, :, :a]).max(axis=0) + np.take(emit, begin[:a] + t, axis=1)
    label = finals.argmax(axis=0)
    for t in range(len(active) - 1, -1, -1):
        a = active[t]
        out[begin[:a] + t] = label[:a]
        if t:
            label[:a] = (were[t - 1] + trans[:, label[:a]]).argmax(axis=0)
    return out


# ---------------------------------------------------------------- labels and spans
def word_spans(text: str | None) -> list[tuple[int, int]]:
    return [m.span() for m in WORDS.finditer(text)] if text else []


def gold_labels(spans: list[tuple[int, int]], entities: list[dict], number: dict[str, int]) -> list[int]:
    """Label numbers of a text's words: those that an entity reaches into begin or continue it."""
    out = [0] * len(spans)
    for e in entities or []:
        if f"B-{e['type']}" in number:
            inside = [i for i, (a, b) in enumerate(spans) if a < e["end_char"] and b > e["start_char"] and out[i] == 0]
            for k, i in enumerate(inside):
                out[i] = number[f"{'BI'[k > 0]}-{e['type']}"]
    return out


def gold_numbers(texts: list[str | None], counts: np.ndarray, starts: np.ndarray, sizes: np.ndarray, entities: pa.ListArray, number: dict[str, int]) -> np.ndarray:
    """``gold_labels`` of the words of all texts (``starts`` and ``sizes`` of each word), one after another."""
    lengths = np.array([len(t) if t else 0 for t in texts], np.int64) + 1
    base, words = np.cumsum(lengths) - lengths, np.cumsum(counts) - counts  # texts and words stand one after another
    begin = starts + np.repeat(base, counts)
    spans, owner = entities.flatten(), np.repeat(np.arange(len(texts)), entities.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    column = lambda name: spans.field(name).to_numpy(zero_copy_only=False)
    kind = np.array([number.get(f"B-{x}", 0) for x in spans.field("type").to_pylist()], np.int64)
    known = (kind > 0) & (counts[owner] > 0)
    owner, kind = owner[known], kind[known]
    # within its text: the words that end after its start and start before its end
    low, high = (np.clip(column(c)[known].astype(np.int64), 0, lengths[owner]) + base[owner] for c in ("start_char", "end_char"))
    first = np.maximum(np.searchsorted(begin + sizes, low, side="right"), words[owner])
    last = np.minimum(np.searchsorted(begin, high, side="left"), words[owner] + counts[owner])
    reach = np.maximum(last - first, 0)
    place = np.arange(reach.sum()) + np.repeat(first - (np.cumsum(reach) - reach), reach)
    out = np.zeros(len(starts), np.int64)
    out[place] = np.repeat(kind, reach) + 1  # inside labels follow their begin labels
    out[first[reach > 0]] = kind[reach > 0]
    twice = np.bincount(place, minlength=len(starts)) > 1
    for i in np.unique(np.repeat(np.arange(len(texts)), counts)[twice]).tolist():  # the earlier of two entities at a word has it
        here = slice(words[i], words[i] + counts[i])
        out[here] = gold_labels([(a, a + n) for a, n in zip(starts[here].tolist(), sizes[here].tolist())], entities[i].as_py(), number)
    return out


def found_spans(text: str, spans: list[tuple[int, int]], labels: list[str]) -> list[dict]:
    out, i = [], 0
    while i < len(labels):
        if labels[i] == "O":
            i += 1
            continue
        kind, first = labels[i][2:], i
        i += 1
        while i < len(labels) and labels[i] == f"I-{kind}":
            i += 1
        (a, b), (c, d) = spans[first], spans[i - 1]
        start, stop = a + bare(text[a:b])[0], c + bare(text[c:d])[1]
        if stop > start:
            out.append({"type": kind, "start_char": start, "end_char": stop})
    return out


# ---------------------------------------------------------------- training
PACKED = "shard int, lengths binary, ids binary, gold binary, features binary"
SHARD = 100_000  # labelled texts
PART = 32        # shards that are summed at once


def packed(batch: pa.RecordBatch, number: dict[str, int], bits: int) -> pa.RecordBatch:
    """A row of ``PACKED`` for the texts of a batch (shard, text, entities) that have words."""
    texts = batch.column("text").to_pylist()
    flat, counts, starts = split_texts(texts)
    encoder = Encoder(bits)
    ids = np.fromiter(map(encoder.__getitem__, flat), np.int64, len(flat))
    gold = gold_numbers(texts, counts, starts, np.fromiter(map(len, flat), np.int64, len(flat)), batch.column("entities"), number)
    small = lambda x, most: x.astype(np.min_scalar_type(most)).tobytes()
    values = [small(counts[counts > 0], 2**32 - 1), small(ids, len(encoder.hashes)), small(gold, len(number)), small(encoder.table(), 2**bits - 1)]
    return pa.RecordBatch.from_arrays([batch.column("shard").slice(0, 1), *(pa.array([x], pa.binary()) for x in values)], names=[c.split()[0] for c in PACKED.split(", ")])


def unpacked(lengths: bytes, ids: bytes, gold: bytes, features: bytes, bits: int, y: int) -> tuple[np.ndarray, ...]:
    lengths = np.frombuffer(lengths, np.uint32).astype(np.int64)
    table = np.frombuffer(features, np.min_scalar_type(2**bits - 1)).astype(np.int64).reshape(-1, len(TEMPLATE))
    return lengths, np.frombuffer(ids, np.min_scalar_type(len(table))).astype(np.int64), np.frombuffer(gold, np.min_scalar_type(y)).astype(np.int64), table


class Pass:
    """Perceptron updates over a shard's texts, ``batch`` of them at a time: the weights now, and their mean over the steps."""

    def __init__(self, params: list[np.ndarray], names: list[str], batch: int):
        self.params, self.late = [p.copy() for p in params], [np.zeros_like(p) for p in params]  # late: updates weighted by the step they came at
        self.limits, self.batch, self.steps = allowed(names), batch, 1

    def learn(self, lengths: np.ndarray, ids: np.ndarray, gold: np.ndarray, table: np.ndarray) -> None:
        """Right texts change nothing, so as many are labelled at once as were right lately; those after a step with an error are labelled
        anew. The updates are those of one step after another."""
        beside, at = with_pads(ids, lengths)
        word, owner = np.append(0, np.cumsum(lengths)), np.repeat(np.arange(len(lengths)), lengths)
        text, window = 0, self.batch
        while text < len(lengths):
            stop = min(len(lengths), text + window)
            here = slice(word[text], word[stop])
            emit = scores(table, beside, at[here], self.params[0])
            got = viterbi(emit, lengths[text:stop], self.params[1] + self.limits[0], self.params[2] + self.limits[1])
            wrong = got != gold[here]
            if not wrong.any():
                self.steps += -(-(stop - text) // self.batch)
                text, window = stop, window * 2
                continue
            right = (owner[here][wrong.argmax()] - text) // self.batch  # steps before the error
            first = text + right * self.batch
            last = min(len(lengths), first + self.batch)
            own = slice(word[first] - word[text], word[last] - word[text])
            self.steps += right
            self.update(table[beside[at[word[first] : word[last]][:, None] + OFFSETS], np.arange(len(TEMPLATE))], lengths[first:last], gold[word[first] : word[last]], got[own])
            text, window = last, self.batch * max(1, int(right))

    def update(self, features: np.ndarray, lengths: np.ndarray, gold: np.ndarray, got: np.ndarray) -> None:
        first = np.cumsum(lengths) - lengths
        inner = np.setdiff1d(np.arange(len(gold)), first)
        wrong = np.flatnonzero(gold != got)
        for sign, labels in ((1.0, gold), (-1.0, got)):
            where = (features[wrong], labels[wrong][:, None]), (labels[inner - 1], labels[inner]), (labels[first],)
            for now, late, place in zip(self.params, self.late, where):
                np.add.at(now, place, sign)
                np.add.at(late, place, sign * self.steps)
        self.steps += 1

    def ends_and_means(self) -> np.ndarray:
        return np.stack([flat(self.params), flat([p - d / self.steps for p, d in zip(self.params, self.late)])])


def flat(params: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([p.ravel() for p in params])


def unflat(x: np.ndarray, bits: int, y: int) -> list[np.ndarray]:
    n = (1 << bits) * y
    return [x[:n].reshape(-1, y), x[n : n + y * y].reshape(y, y), x[n + y * y :]]


def summed(rows: DataFrame, size: int, by: list[str | Column]) -> DataFrame:
    """Rows (part, block, n, at, payload), with values where they are not 0, summed by ``by``, in the order of ``part``."""
    def add(part: pa.Table) -> pa.Table:
        part = part.sort_by("part")
        block, n = part.column("block")[0].as_py(), sum(part.column("n").to_pylist())
        cuts = np.linspace(0, size, BLOCKS + 1).astype(int)
        total = np.zeros((2, cuts[block + 1] - cuts[block]))
        for at, x in zip(part.column("at"), part.column("payload")):
            total[:, np.frombuffer(at.as_py(), np.int32)] += np.frombuffer(x.as_py()).reshape(2, -1)
        return pa.table(sparse(total, part.column("part")[0].as_py(), block, n))

    return rows.groupBy(*by).applyInArrow(add, SPARSE)


SPARSE = "part int, block int, n int, at binary, payload binary"


def sparse(values: np.ndarray, part: int, block: int, n: int) -> dict:
    """A row of ``SPARSE``: the values of a block, those that are 0 in both lines left out."""
    at = np.flatnonzero(values.any(axis=0)).astype(np.int32)
    ints = {k: pa.array([x], pa.int32()) for k, x in (("part", part), ("block", block), ("n", n))}
    return ints | {"at": pa.array([at.tobytes()], pa.binary()), "payload": pa.array([values[:, at].tobytes()], pa.binary())}


def train(labelled: DataFrame, id_col: str, text_col: str, entities_col: str, types: list[str], rounds: int = 4, shards: int = 8, bits: int = 16,
          batch: int = 8) -> dict:
    """A model from all texts with entities (array of structs with type, start_char, end_char). Null and empty texts teach nothing;
    without any text the model finds nothing. ``shards``: the least number of them."""
    spark = labelled.sparkSession
    names = label_names(sorted(types))
    number, y = {n: i for i, n in enumerate(names)}, len(names)
    rows = labelled.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.transform(entities_col, lambda e: F.struct(e["type"].alias("type"), e["start_char"].alias("start_char"), e["end_char"].alias("end_char"))).alias("entities"))
    shards = max(shards, -(-rows.count() // SHARD))
    # texts without an id, or with the same one, are dealt out too
    rows = rows.withColumn("o", F.xxhash64("id")).repartition(shards, "o", "text").sortWithinPartitions("o", "id", "text")

    def pack(batches):
        for b in batches:
            if b.num_rows:
                yield packed(b, number, bits)

    rows = materialize(rows.select(F.spark_partition_id().alias("shard"), "text", "entities").mapInArrow(pack, PACKED), "tagger-rows")
    size = (1 << bits) * y + y * y + y
    cuts = np.linspace(0, size, BLOCKS + 1).astype(int)
    mixed, mean = np.zeros(size), np.zeros(size)
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(mixed.astype(np.float32))

        def learn(batches):
            now = shard = None

            def result():
                both = now.ends_and_means()
                for i in range(BLOCKS):
                    yield pa.RecordBatch.from_pydict(sparse(both[:, cuts[i] : cuts[i + 1]], shard, i, 1))

            for b in batches:
                for of, *values in zip(*(b.column(c.split()[0]) for c in PACKED.split(", "))):
                    if now is not None and of.as_py() != shard:
                        yield from result()
                        now = None
                    lengths, *words = unpacked(*(x.as_py() for x in values), bits, y)
                    if len(lengths):
                        now, shard = now or Pass(unflat(shared.value.astype(np.float64), bits, y), names, batch), of.as_py()
                        now.learn(lengths, *words)
            if now is not None:
                yield from result()

        ends = rows.mapInArrow(learn, SPARSE)
        if shards > PART:
            ends = summed(ends, size, ["block", F.floor(F.col("part") / PART)])
        blocks = summed(ends, size, ["block"]).orderBy("block").collect()  # the model, twice
        if not blocks:
            break
        both = np.zeros((2, size))
        for r in blocks:
            both[:, cuts[r.block] + np.frombuffer(r.at, np.int32)] = np.frombuffer(r.payload).reshape(2, -1) / r.n
        mixed, now = both
        mean = mean + now / rounds
    weights, trans, start = unflat(mean, bits, y)
    return {"names": names, "bits": bits, "weights": weights.astype(np.float32), "trans": trans, "start": start, "trained": bool(np.any(mean))}


# ---------------------------------------------------------------- prediction
def tag_lists(texts: list[str | None], model: dict) -> pa.ListArray:
    """Entities (type, start_char, end_char) of each text: as ``found_spans`` makes them, for all texts at once."""
    flat, lengths, starts = split_texts(texts)
    none = np.zeros(0, np.int64)
    if not model["trained"] or not len(flat):
        return span_lists(np.zeros(len(texts), np.int64), none, [], none, none)
    names = model["names"]
    may_follow, may_start = allowed(names)
    encoder = Encoder(model["bits"])
    ids = np.fromiter(map(encoder.__getitem__, flat), np.int64, len(flat))
    labels = viterbi(scores(encoder.table(), *with_pads(ids, lengths), model["weights"]), lengths, model["trans"] + may_follow, model["start"] + may_start)
    kinds = sorted({n[2:] for n in names if n != "O"})
    kind = np.array([-1 if n == "O" else kinds.index(n[2:]) for n in names])[labels]
    inside = np.array([n[0] == "I" for n in names])[labels]
    owner = np.repeat(np.arange(len(texts)), lengths)
    goes_on = np.append(False, inside[1:] & (kind[1:] == kind[:-1]) & (owner[1:] == owner[:-1]))
    first = np.flatnonzero((kind >= 0) & ~goes_on)
    last = np.flatnonzero((kind >= 0) & ~np.append(goes_on[1:], False))
    places = np.array(encoder.places, np.int64)
    start, stop = starts[first] + places[ids[first], 0], starts[last] + places[ids[last], 1]
    some = stop > start
    return span_lists(np.bincount(owner[first][some], minlength=len(texts)), kind[first][some], kinds, start[some], stop[some])


def tag(texts: list[str | None], model: dict) -> list[list[dict]]:
    """Entities (type, start_char, end_char) of each text."""
    return tag_lists(texts, model).to_pylist()


def spans_udf(spark, model: dict):
    shared = spark.sparkContext.broadcast(model)  # of fixed size
    kind = T.ArrayType(T.StructType([T.StructField("type", T.StringType()), T.StructField("start_char", T.IntegerType()), T.StructField("end_char", T.IntegerType())]))

    def spans(text: pa.Array) -> pa.Array:
        return tag_lists(text.to_pylist(), shared.value)

    spans.__annotations__ = {"text": pa.Array, "return": pa.Array}
    return F.arrow_udf(spans, kind).asNondeterministic()  # only to keep Catalyst from repeating the call in filters
