"""Language identification by a linear-chain conditional random field over words.

Every word (a run of letters, lower-cased; a run of over 40 letters, as in text without separators, is cut into words of 40
that together cover it) has a label, its language; the chain's transitions let a text switch between
languages. Features of a word: prefixes and suffixes of one to three letters, its letter trigrams with word ends, and the
languages in which the lexicon knows it. Forward-backward gives each word's label probabilities; a document's language is
the label with the largest mean probability, and that mean is its score.

Training.
* The lexicon counts every word of every training row by language, in Spark: tasks add up dense tables of hashed words
  (``lexicon_bits``, a fixed size), the tables' blocks are summed by a shuffle, and the finished table, of fixed size,
  comes to the driver.
* The weights are fitted by forward-backward and gradient steps on a bounded sample: for each language the
  ``sample_rows`` training rows with the least hash of their id among those of at most ``sample_chars`` characters. The
  sequences are cut from rows of several languages, so that transitions between languages are seen.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; without labelled training rows all are; rows
without a doc_id are left out; rows that repeat a doc_id are each labelled; ties go to the first label in alphabetical
order; a null lang is never learned from; empty tables work; further columns are ignored.
"""

from __future__ import annotations

import re
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textforge._ship import by_value
from textforge.llm.common import PACKED, id_text, kept_slices, packed_batch, text_rows, unkept, with_kept, worker_table

by_value(__name__)

LETTERS = re.compile(r"[^\W\d_]{1,40}")
BLOCK = 1 << 14


ASCII_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 else 32 for c in range(256))  # small letters; all else a space


def letter_words(text: bytes | None) -> list[str]:
    if not text:
        return []
    if text.isascii():
        words = text.translate(ASCII_LETTERS).decode("ascii").split()
        if not words or max(map(len, words)) <= 40:
            return words
    return LETTERS.findall(text.decode("utf-8", "replace").lower())


def features(word: str, bits: int) -> list[int]:
    """Hashed affixes and n-grams of a word."""
    size, crc = (1 << bits) - 1, zlib.crc32
    w = word.encode()
    if len(w) == len(word):  # a letter is a byte
        t = b"^" + w + b"$"
        return [crc(w[:1], 11) & size, crc(w[:2], 11) & size, crc(w[:3], 11) & size, crc(w[-1:], 29) & size, crc(w[-2:], 29) & size, crc(w[-3:], 29) & size,
                *[crc(t[i : i + 3], 47) & size for i in range(len(t) - 2)], crc(w, 83) & size]
    out = [crc(word[:i].encode(), 11) & size for i in (1, 2, 3)] + [crc(word[-i:].encode(), 29) & size for i in (1, 2, 3)]
    t = "^" + word + "$"
    return out + [crc(t[i : i + 3].encode(), 47) & size for i in range(len(t) - 2)] + [crc(w, 83) & size]


def lexicon_slot(word: str, bits: int) -> int:
    return zlib.crc32(word.encode(), 101) & ((1 << bits) - 1)


# ---------------------------------------------------------------- the chain
def normal(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=-1, keepdims=True)


def marginals(emit: np.ndarray, trans: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over a batch (sequences, words, labels): label probabilities and summed pair probabilities."""
    b, t, y = emit.shape
    e = np.exp(emit - emit.max(axis=2, keepdims=True))
    m = np.exp(trans)
    alpha = np.empty_like(e)
    alpha[:, 0] = normal(np.exp(start) * e[:, 0])
    for i in range(1, t):
        alpha[:, i] = normal((alpha[:, i - 1] @ m) * e[:, i])
    beta, pairs = np.ones((b, y)), np.zeros((y, y))
    out = np.empty_like(e)
    out[:, -1] = alpha[:, -1]
    for i in range(t - 2, -1, -1):
        right = e[:, i + 1] * beta
        joint = alpha[:, i, :, None] * m * right[:, None, :]
        pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        beta = normal(right @ m.T)
        out[:, i] = normal(alpha[:, i] * beta)
    return out, pairs


def exponentials(emit: np.ndarray) -> np.ndarray:
    """Label scores of words as the factors of the chain, the largest of a word being 1."""
    emit = emit.astype(np.float64)
    return np.exp(emit - emit.max(axis=1, keepdims=True))


SCALE_EVERY = 4  # steps between which the factors cannot leave the range of a double


def ragged_marginals(factors: np.ndarray, ids: np.ndarray, lengths: np.ndarray, trans: np.ndarray, start: np.ndarray, keep: bool = False):
    """Mean label probabilities of each sequence of a ragged batch (and, if ``keep``, those of every word).

    ``ids`` are the rows in ``factors`` (``exponentials``) of the words of the sequences, one sequence after another. Step t works
    on all sequences longer than t at once."""
    rank = np.argsort(-lengths, kind="stable")
    sizes = lengths[rank]
    steps = int(sizes[0])
    active = np.searchsorted(-sizes, -np.arange(1, steps + 1), side="right")  # sequences with more than t words
    first = np.cumsum(active) - active
    begin = (np.cumsum(lengths) - lengths)[rank]
    seq = np.repeat(np.arange(len(sizes)), sizes)
    t = np.arange(len(ids)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    place = np.empty(len(ids), np.int64)  # of each word in step order
    place[np.repeat(begin, sizes) + t] = first[t] + seq
    ordered = np.empty_like(ids)
    ordered[place] = ids
    e = factors[ordered]
    m, alpha = np.exp(trans), np.empty_like(e)
    back = np.ascontiguousarray(m.T)
    now = e[: active[0]] * np.exp(start)
    alpha[: active[0]] = now
    active, first = active.tolist(), first.tolist()
    for i in range(1, steps):
        a, f = active[i], first[i]
        now = (now[:a] @ m) * e[f : f + a]
        if i % SCALE_EVERY == 0:
            now /= now.sum(axis=1, keepdims=True)
        alpha[f : f + a] = now
    total = np.zeros((len(sizes), e.shape[1]))
    beta = np.ones_like(total)
    for i in range(steps - 1, -1, -1):
        a, f = active[i], first[i]
        p = alpha[f : f + a] * beta[:a]
        p /= p.sum(axis=1, keepdims=True)
        total[:a] += p
        if keep:
            alpha[f : f + a] = p
        if i:
            right = (e[f : f + a] * beta[:a]) @ back
            if i % SCALE_EVERY == 0:
                right /= right.sum(axis=1, keepdims=True)
            beta[:a] = right
    mean = np.empty_like(total)
    mean[rank] = total / sizes[:, None]
    return (mean, alpha[place]) if keep else (mean, None)


# ---------------------------------------------------------------- training
class Slots(dict):
    """Lexicon slots of the words seen."""

    def __init__(self, bits: int):
        super().__init__()
        self.bits = bits

    def __missing__(self, word: str) -> int:
        self[word] = slot = lexicon_slot(word, self.bits)
        return slot


def lexicon(rows: DataFrame, labels: list[str], bits: int) -> np.ndarray:
    """Counts of hashed words by language, of all training rows."""
    number = {x: i for i, x in enumerate(labels)}
    size = 1 << bits

    def count(batches):
        table = np.zeros((len(labels), size), np.uint32)
        seen = Slots(bits)
        for batch in batches:
            slots: list[list[int]] = [[] for _ in labels]
            for lang, (_, text) in zip(batch.column("lang").to_pylist(), text_rows([batch])):
                slots[number[lang]].extend(map(seen.__getitem__, letter_words(text)))
                if len(seen) > 500_000:
                    seen.clear()
            for row, s in zip(table, slots):
                if s:
                    np.add(row, np.bincount(np.array(s, np.int64), minlength=size), out=row, casting="unsafe")
        table = np.ascontiguousarray(table.T)
        if table.any():
            yield packed_batch([(b, table[b * BLOCK : (b + 1) * BLOCK].astype(kind := np.min_scalar_type(int(table[b * BLOCK : (b + 1) * BLOCK].max()))).tobytes() + bytes([kind.itemsize])) for b in range(size // BLOCK)])

    def add(part: pa.Table) -> pa.Table:
        total = np.zeros(BLOCK * len(labels), np.uint64)
        for x in part.column("payload"):
            x = x.as_py()
            total += np.frombuffer(x, f"<u{x[-1]}", len(total))
        return pa.table({"bucket": pa.array([part.column("bucket")[0].as_py()], pa.int32()), "payload": pa.array([total.tobytes()], pa.binary())})

    out = np.zeros((size, len(labels)), np.uint64)
    for r in rows.select("doc_id", "text", "lang").mapInArrow(count, PACKED).groupBy("bucket").applyInArrow(add, PACKED).collect():
        out[r.bucket * BLOCK : (r.bucket + 1) * BLOCK] = np.frombuffer(r.payload, np.uint64).reshape(-1, len(labels))
    return out


def lexicon_scores(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Log rates of a word by language, less their mean; none for words that no language has."""
    rate = np.log((counts + 0.1) / (totals + 1.0))
    return np.where(counts.sum(axis=1, keepdims=True) > 0, rate - rate.mean(axis=1, keepdims=True), 0.0)


def fit(sample: list[tuple[str, str]], labels: list[str], counts: np.ndarray, bits: int, lexicon_bits: int, words: int = 48,
        batch: int = 64, epochs: int = 3, rate: float = 0.3, seed: int = 7) -> dict:
    """Weights by gradient steps (Adagrad) on sequences cut from rows of several languages."""
    rng = np.random.default_rng(seed)
    number = {x: i for i, x in enumerate(labels)}
    known: dict[str, int] = {}
    runs = []  # (label, word numbers): stretches of one row
    for text, lang in sample:
        ws = [known.setdefault(w, len(known)) for w in letter_words(text.encode())]
        at = 0
        while at < len(ws):
            n = int(rng.integers(4, 40))
            runs.append((number[lang], ws[at : at + n]))
            at += n
    found = [features(w, bits) for w in known]
    width = np.fromiter(map(len, found), np.int64, len(found))
    flat, first = np.fromiter((x for f in found for x in f), np.int64, int(width.sum())), np.cumsum(width) - width
    slots = np.fromiter((lexicon_slot(w, lexicon_bits) for w in known), np.int64, len(known))
    totals = counts.sum(axis=0).astype(float)
    y = len(labels)
    weights, trans, start, scale = np.zeros((1 << bits, y)), np.zeros((y, y)), np.zeros(y), 0.1
    gw, gt, gs, gc = (np.full(x.shape, 1e-6) for x in (weights, trans, start, np.zeros(1)))
    for _ in range(epochs):
        order = rng.permutation(len(runs))
        ws = np.array([w for i in order for w in runs[i][1]], np.int64)
        gold = np.array([runs[i][0] for i in order for _ in runs[i][1]], np.int64)
        n = len(ws) // words
        for at in range(0, n, batch):
            k = min(batch, n - at)
            w, g = ws[at * words : (at + k) * words], gold[at * words : (at + k) * words]
            distinct, place = np.unique(w, return_inverse=True)
            take = np.repeat(first[distinct] - (np.cumsum(width[distinct]) - width[distinct]), width[distinct]) + np.arange(width[distinct].sum())
            ids = flat[take]
            emit = np.add.reduceat(weights[ids], np.cumsum(width[distinct]) - width[distinct])[place]
            hot = np.eye(y)[g]
            lex = lexicon_scores(np.maximum(counts[slots[w]].astype(float) - hot, 0), totals)  # without this word itself
            p, pairs = marginals((emit + scale * lex).reshape(k, words, y), trans, start)
            gap = hot - p.reshape(-1, y)
            per_word = np.zeros((len(distinct), y))
            np.add.at(per_word, place, gap)
            grad = np.zeros_like(weights)
            np.add.at(grad, ids, np.repeat(per_word, width[distinct], axis=0))
            seen = np.zeros((y, y))
            gg = g.reshape(k, words)
            np.add.at(seen, (gg[:, :-1].ravel(), gg[:, 1:].ravel()), 1)
            begin = hot.reshape(k, words, y)[:, 0].sum(axis=0) - p[:, 0].sum(axis=0)
            for x, h, d in ((weights, gw, grad - 1e-4 * weights), (trans, gt, seen - pairs - 1e-2 * trans), (start, gs, begin)):
                d = d / k
                h += d * d
                x += rate * d / np.sqrt(h)
            d = float((gap * lex).sum()) / (k * words)
            gc += d * d
            scale += 0.1 * d / float(np.sqrt(gc[0]))
    return {"labels": labels, "bits": bits, "lexicon_bits": lexicon_bits, "weights": weights.astype(np.float32), "trans": trans, "start": start,
            "lexicon": (scale * lexicon_scores(counts.astype(float), totals)).astype(np.float32)}


def train(docs: DataFrame, sample_rows: int = 250, sample_chars: int = 20_000, bits: int = 16, lexicon_bits: int = 17) -> dict:
    """A model from all rows of ``docs`` (doc_id, text, lang) with a language."""
    rows = docs.filter("lang is not null and text is not null")
    labels = sorted(r.lang for r in rows.select("lang").distinct().collect())
    if not labels:
        return {"labels": []}
    counts = lexicon(rows, labels, lexicon_bits)
    order = F.struct(F.xxhash64("doc_id"), "doc_id")
    short = rows.filter(F.length("text").between(1, sample_chars)).select("doc_id", "lang", order.alias("o"))
    picked = short.withColumn("n", F.row_number().over(W.partitionBy("lang").orderBy("o"))).filter(F.col("n") <= sample_rows).select("doc_id").distinct()
    sample = [(r.text, r.lang) for r in rows.filter(F.length("text").between(1, sample_chars)).join(F.broadcast(picked), "doc_id").select("doc_id", "text", "lang").orderBy("doc_id", "lang", "text").collect()]
    return fit(sample, labels, counts, bits, lexicon_bits)


# ---------------------------------------------------------------- prediction
def joined_batches(batches, most_bytes: int = 24_000_000):
    """Arrow batches put together, so that long texts share the steps of the chain."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= most_bytes:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


class Numbers(dict):
    """Numbers of words, in the order in which they come; words of the generation before are found in it."""

    def __init__(self, before: dict[str, int]):
        super().__init__()
        self.before, self.new, self.known = before, [], []

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        old = self.before.get(word)
        if old is None:
            self.new.append((number, word))
        else:
            self.known.append((number, old))
        return number


class Emissions:
    """The factors of words, kept for the words seen. When ``most`` are held a new generation begins, which takes over the words
    that it meets again; so rare words go and frequent ones are never computed twice."""

    def __init__(self, model: dict, most: int = 400_000):
        self.model, self.most = model, most
        self.seen = Numbers({})
        self.rows = self.old_rows = np.zeros((1 << 12, len(model["labels"])))

    def next_generation(self) -> None:
        self.seen, self.old_rows = Numbers(dict(self.seen)), self.rows
        self.rows = np.zeros((1 << 12, self.rows.shape[1]))

    def numbers(self, words: list[str]) -> np.ndarray:
        seen = self.seen
        at = np.fromiter(map(seen.__getitem__, words), np.int64, len(words))
        if seen.new or seen.known:
            while len(self.rows) < len(seen):
                self.rows = np.resize(self.rows, (2 * len(self.rows), self.rows.shape[1]))
            if seen.known:
                to, old = zip(*seen.known)
                self.rows[list(to)] = self.old_rows[list(old)]
            if seen.new:
                to, new = zip(*seen.new)
                self.rows[list(to)] = self.factors(new)
            seen.new, seen.known = [], []
        return at

    def factors(self, words: list[str]) -> np.ndarray:
        m = self.model
        found = [features(w, m["bits"]) for w in words]
        width = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((x for f in found for x in f), np.int64, int(width.sum()))
        slots = np.fromiter((lexicon_slot(w, m["lexicon_bits"]) for w in words), np.int64, len(words))
        return exponentials(np.add.reduceat(m["weights"][flat], np.cumsum(width) - width) + m["lexicon"][slots])


def predict(docs: DataFrame, model: dict, with_spans: bool = False, keep: list[str] | None = None) -> DataFrame:
    """doc_id, lang_pred, score (and spans: first word, words, language, by the most probable label of each word); then the
    columns ``keep`` of the input row."""
    labels = model["labels"]
    name = uuid.uuid4().hex
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size
    kinds = [pa.string(), pa.float64(), pa.list_(pa.struct([("first", pa.int64()), ("words", pa.int64()), ("lang", pa.string())]))]

    def run(batches):
        # the worker process keeps the words' scores from task to task
        table = worker_table(("crf", name), lambda: Emissions(shared.value)) if labels else None

        def label(parts):
            out = [("und", 0.0, [])] * len(parts)
            full = [i for i, p in enumerate(parts) if len(p)]
            if full and labels:
                m = table.model
                lengths = np.array([len(parts[i]) for i in full], np.int64)
                mean, each = ragged_marginals(table.rows, np.concatenate([parts[i] for i in full]), lengths, m["trans"], m["start"], with_spans)
                best = mean.argmax(axis=1)
                at = 0
                for i, n, b, row in zip(full, lengths.tolist(), best.tolist(), mean):
                    runs = []
                    if with_spans:
                        top = each[at : at + n].argmax(axis=1)
                        cuts = np.flatnonzero(np.append(True, top[1:] != top[:-1]))
                        runs = [{"first": int(c), "words": int(d - c), "lang": labels[top[c]]} for c, d in zip(cuts, np.append(cuts[1:], n))]
                    at += n
                    out[i] = (labels[b], min(1.0, float(row[b])), runs)
            return out

        for batch in joined_batches(batches):
            out: list = [None] * batch.num_rows
            # long texts wait for one another: a step of the chain takes as long for one text as for many
            waiting: dict[bool, list] = {False: [], True: []}
            words = {False: 0, True: 0}

            def flush(*kinds):
                for long in kinds:
                    at = [i for i, _ in waiting[long]]
                    for i, x in zip(at, label([p for _, p in waiting[long]])):
                        out[i] = x
                    waiting[long], words[long] = [], 0

            for i, (_, text) in enumerate(text_rows([batch])):
                ws = letter_words(text)
                long = len(ws) > 1500
                waiting[long].append((i, table.numbers(ws) if ws and labels else ws))
                words[long] += len(ws)
                if words[long] >= (600_000 if long else 100_000):
                    flush(long)
                if table and len(table.seen) > table.most:
                    flush(False, True)
                    table.next_generation()
            flush(False, True)
            cols = list(zip(*out))[: 3 if with_spans else 2] or [(), (), ()][: 3 if with_spans else 2]
            more, more_names = kept_slices(batch, 0, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id")] + [pa.array(c, k) for c, k in zip(cols, kinds)] + more, names=["doc_id", "lang_pred", "score", "spans"][: 1 + len(cols)] + more_names)

    schema = "doc_id long, lang_pred string, score double" + ", spans array<struct<first:long,words:long,lang:string>>" * with_spans
    rows = id_text(docs, keep=keep)
    return unkept(rows.mapInArrow(run, with_kept(schema, rows)))


def held_out(of: int = 5) -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(of)) == 0


def identify(docs: DataFrame, of: int = 5, keep: list[str] | None = None, **training) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learned from the rows whose crc32(doc_id) modulo ``of`` is not 0."""
    rows = docs.filter("doc_id is not null")
    known = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    model = train(known.filter(~held_out(of)), **training)
    return predict(rows, model, keep=keep).withColumn("held_out", held_out(of))
