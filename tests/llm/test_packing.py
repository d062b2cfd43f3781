import zlib
from collections import defaultdict

import numpy as np
import pytest

from textforge.llm.packing import best_fit, pack, word_cache

SCHEMA = "doc_id long, text string, piece string, shard int"


def expected(texts, seq_len):
    tokenizer = word_cache("word_bpe_49k.json", 1000).tokenizer
    out = []
    for doc, text in texts:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        out += [(doc, n, s, len(p := ids[s : s + seq_len]), zlib.crc32(p.tobytes())) for n, s in enumerate(range(0, len(ids), seq_len))]
    return sorted(out, key=str)


def test_pieces_and_places(spark):
    rows = [(1, "The quick brown fox"), (2, None), (3, ""), (4, "wörd " * 900), (4, "a b c"), (None, "no id"), (5, "x y\x1cz <|endoftext|> it's"), (6, "  \n")]
    docs = spark.createDataFrame([(a, b, "clash", 7) for a, b in rows], SCHEMA)
    got = pack(docs, seq_len=64, shard_tokens=300, open_bins=4, with_ids=True).collect()
    assert sorted([tuple(r)[:5] for r in got], key=str) == expected(rows, 64)
    places = defaultdict(list)
    for r in got:
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
        places[r.sequence_id].append((r.offset, r.length))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 64


def test_empty_table(spark):
    assert pack(spark.createDataFrame([], SCHEMA)).collect() == []


def test_equal_rows_spread_over_the_shards(spark):
    """200,000 rows alike: no shard has much more than its share, and the sequences are full."""
    rows = spark.range(0, 200_000, 1, 4).selectExpr("cast(null as long) as doc_id", "cast(null as string) as text")
    got = pack(rows, seq_len=64, shard_pieces=20_000).selectExpr("sequence_id >> 32 as shard", "sequence_id", "offset").cache()
    shards = [r["count"] for r in got.groupBy("shard").count().collect()]
    assert len(shards) == 10 and max(shards) < 22_000 and sum(shards) == 200_000
    assert got.select("sequence_id").distinct().count() <= 200_000 // 64 + 10


def test_the_bound_on_open_bins_acts(spark):
    """Pieces of two lengths of which none fits beside another: with more bins than the bound allows, bins are closed."""
    lengths = [33] * 200 + [31] * 200
    bins, _ = best_fit(lengths, 64, 8)
    assert max(bins) + 1 == 200 + 100 - 4  # 8 of the 200 bins are still open when the short pieces come
    assert max(best_fit(lengths, 64, 1000)[0]) + 1 == 200


def test_long_text_and_ties(spark):
    rows = spark.createDataFrame([(1, "word " * 200_000, "x", 1), (2, "a b", "x", 1), (3, "a b", "x", 1)], SCHEMA)
    got = pack(rows, seq_len=2048).collect()
    long = sorted((r.piece, r.start, r.length) for r in got if r.doc_id == 1)
    assert [p for p, *_ in long] == list(range(len(long))) and all(s == 2048 * p for p, s, _ in long) and sum(n for *_, n in long) >= 200_001
    assert len({r.ids_crc32 for r in got if r.doc_id != 1}) == 1


@pytest.mark.parametrize("open_bins", [1, 3, 50])
def test_best_fit_against_plain(open_bins):
    lengths = np.random.default_rng(open_bins).integers(1, 101, 500).tolist()
    bins, offsets = best_fit(lengths, 100, open_bins)
    left: dict[int, int] = {}
    opened: list[int] = []  # free space of the open bins
    for need, at, offset in zip(lengths, bins, offsets):
        fits = [f for f in opened if f >= need]
        if fits:
            assert left[at] == min(fits) and offset == 100 - left[at]
            opened.remove(min(fits))
        else:
            if len(opened) == open_bins:
                opened.remove(min(opened))
            assert at not in left and offset == 0
        left[at] = left.get(at, 100) - need
        opened += [left[at]] * (left[at] > 0)
