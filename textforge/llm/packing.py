"""Best-fit packing: documents to token sequences of a fixed length.

Method: bounded-space online best fit. A shard of pieces is packed in one pass with a fixed number of open bins. A
bitset (one integer) has a bit for every amount of free space of which some open bin exists, so the bin that fits best
is the lowest set bit at or above the piece's length. If no bin fits and the number of open bins is reached, the
fullest closes first (the lowest set bit of all).

Spark tokenises documents in parallel, then deals the pieces (a few numbers each, no text) over shards of about
``shard_tokens`` tokens, and of ``shard_pieces`` pieces at most on average, by a hash of their ids and of their row in the written
table; one shard is one task's group, of bounded size, also where one row is repeated very often. A shard has thousands of
sequences, far more than ``open_bins``, so the bound decides. Pieces arrive in the order of the hash, as a stream would bring them.

Defined cases: a null or empty text is one piece that holds the end id alone; a null doc_id is kept as null; repeated
rows are packed each for itself; of bins with equal free space the one filled last is taken; an empty table gives no rows; further
columns are ignored. A text of any length is tokenised whole, as one task's arrays of words and ids.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textforge._ship import by_value
from textforge.llm.common import bucket_count, id_text, text_rows, worker_table
from textforge.session import materialize

by_value(__name__)

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Seen(dict):
    """Word to number; an unseen word gets the next number and is noted."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self.new.append(word)
        self[word] = at = len(self)
        return at


class WordCache:
    """Ids of the tokenizer, looked up by white-space word.

    The tokenizer drops white space and never joins across it, so a text's ids are its words' ids one after another.
    A bounded table keeps the ids of words seen by this worker; it starts anew when it is full.
    """

    def __init__(self, vocabulary: str, most_words: int):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if not os.path.isabs(vocabulary):
            import public_tokenizers

            vocabulary = public_tokenizers.path(vocabulary)
        self.tokenizer, self.most = Tokenizer.from_file(vocabulary), most_words
        self.clear()

    def clear(self) -> None:
        self.seen = Seen()
        self.start, self.length = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)
        self.ids, self.used = np.zeros(1 << 14, np.uint32), 0

    def learn(self) -> None:
        """Ids of the noted words: many words as one text, then cut at the words' first characters."""
        words, self.seen.new = self.seen.new, []
        first = len(self.seen) - len(words)
        for at in range(0, len(words), 4096):
            part = [w.decode("utf-8", "replace") for w in words[at : at + 4096]]
            begins = np.cumsum([0] + [len(w) + 1 for w in part])
            found = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            flat = np.array(found.ids, np.uint32)
            where = np.fromiter((x for x, _ in found.offsets), np.int64, len(flat))
            ends = np.searchsorted(where, begins[1:])
            n, have = first + at, len(part)
            if len(self.start) < n + have:
                more = max(2 * len(self.start), n + have)
                self.start, self.length = np.resize(self.start, more), np.resize(self.length, more)
            if len(self.ids) < self.used + len(flat):
                self.ids = np.resize(self.ids, max(2 * len(self.ids), self.used + len(flat)))
            self.ids[self.used : self.used + len(flat)] = flat
            self.start[n : n + have] = self.used + np.append(0, ends[:-1])
            self.length[n : n + have] = np.diff(ends, prepend=0)
            self.used += len(flat)

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        if len(self.seen) > self.most:
            self.clear()
        look = self.seen.__getitem__
        numbers = [np.fromiter(map(look, words), np.int64, len(words)) for words in (t.split() for t in texts)]
        if self.seen.new:
            self.learn()
        out = []
        for at in numbers:
            lengths = self.length[at]
            ends = np.cumsum(lengths)
            take = np.repeat(self.start[at] - (ends - lengths), lengths)
            out.append(self.ids[take + np.arange(len(take))])
        return out


def word_cache(vocabulary: str, most_words: int) -> WordCache:
    """The worker process's cache; it outlives a task, as this module (sent by value) does not."""
    return worker_table(("words", vocabulary, most_words), lambda: WordCache(vocabulary, most_words))


def token_pieces(docs: DataFrame, seq_len: int, vocabulary: str, end_id: int = 0, with_ids: bool = False,
                 cache_words: int = 700_000) -> DataFrame:
    """Pieces of at most ``seq_len`` tokens; only documents that are longer are cut. ``with_ids`` adds the ids."""

    def run(batches):
        cache = word_cache(vocabulary, cache_words)
        rows: list[tuple] = []

        def out():
            cols = list(zip(*rows))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.list_(pa.int64())] * with_ids
            names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

        def cut(held):
            for (doc, _), ids in zip(held, cache.encode([text for _, text in held])):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for piece, s in enumerate(range(0, len(ids), seq_len)):
                    part = ids[s : s + seq_len]
                    rows.append((doc, piece, s, len(part), zlib.crc32(part.tobytes())) + ((part.tolist(),) if with_ids else ()))

        held, size = [], 0
        for doc, text in text_rows(batches):
            held.append((doc, text or b""))
            size += len(held[-1][1])
            if size >= 2_000_000 or len(held) >= 4096:
                cut(held)
                yield out()
                rows.clear()
                held, size = [], 0
        if held:
            cut(held)
            yield out()

    return id_text(docs).mapInArrow(run, PIECES + ", ids array<long>" * with_ids)


def best_fit(lengths, seq_len: int, open_bins: int) -> tuple[list[int], list[int]]:
    """Bin and offset of every piece, online with at most ``open_bins`` open bins."""
    by_free: list[list[int]] = [[] for _ in range(seq_len + 1)]
    mask = made = held = 0
    bins, offsets = [], []
    for need in lengths:
        fits = mask >> need
        if fits:
            free = need + (fits & -fits).bit_length() - 1
            at = by_free[free].pop()
            if not by_free[free]:
                mask ^= 1 << free
            held -= 1
        else:
            if held == open_bins:
                fullest = (mask & -mask).bit_length() - 1
                by_free[fullest].pop()
                if not by_free[fullest]:
                    mask ^= 1 << fullest
                held -= 1
            at, free = made, seq_len
            made += 1
        bins.append(at)
        offsets.append(seq_len - free)
        left = free - need
        if left:
            by_free[left].append(at)
            mask |= 1 << left
            held += 1
    return bins, offsets


def pack(docs: DataFrame, seq_len: int = 2048, vocabulary: str = "word_bpe_49k.json", end_id: int = 0, open_bins: int = 64,
         shard_tokens: int = 20_000_000, shard_pieces: int = 500_000, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids)."""
    pieces = materialize(token_pieces(docs, seq_len, vocabulary, end_id, with_ids), "packing-pieces")
    total = pieces.agg(F.sum("length").alias("tokens"), F.count("*").alias("n")).first()
    shards = max(bucket_count(total.tokens or 0, shard_tokens, 1), bucket_count(total.n, shard_pieces, 1))

    def fill(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["order", "row"], kind="stable")
        bins, offsets = best_fit(part["length"].tolist(), seq_len, open_bins)
        part["sequence_id"] = part["shard"].astype("int64") * (1 << 32) + np.array(bins, np.int64)
        part["offset"] = np.array(offsets, np.int64)
        return part.drop(columns=["order", "row", "shard"])

    # the row tells repeated rows apart: the written table is read in the same splits by a repeated task
    dealt = pieces.withColumn("row", F.monotonically_increasing_id()).withColumn("order", F.xxhash64("doc_id", "piece", "ids_crc32", "row"))
    schema = PIECES + ", ids array<long>" * with_ids + ", sequence_id long, offset long"
    return dealt.withColumn("shard", F.pmod("order", F.lit(shards)).cast("int")).groupBy("shard").applyInPandas(fill, schema)
