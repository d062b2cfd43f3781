import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from textforge.llm.kneser_ney import discounts, score_held_out

SCHEMA = "doc_id long, text string, score double, bucket int"


def tokens(text):
    return [w.lower() for w in (text or "").encode().split()] + [None]


def expected(rows):
    rows = [r for r in rows if r[0] is not None]
    out_of = lambda d: zlib.crc32(str(d).encode()) % 7 == 2
    words, pairs = Counter(), Counter()
    for d, t in rows:
        if not out_of(d):
            w = tokens(t)
            words.update(w)
            pairs.update(zip([None] + w, w))
    n, v = sum(words.values()), len(words)
    follow, after = Counter(w for _, w in pairs), defaultdict(list)
    for (u, _), c in pairs.items():
        after[u].append(c)
    numbers = lambda x: [sum(c == i for c in x.values()) for i in (1, 2, 3, 4)]
    d2, d1 = discounts(numbers(pairs)), discounts(numbers(follow))
    kinds = len(pairs)

    def low(w):
        spare = sum(d1[min(c, 3)] for c in follow.values()) / kinds if kinds else 1.0
        return spare / (v + 1) + (max(follow[w] - d1[min(follow[w], 3)], 0) / kinds if kinds else 0)

    def p(u, w):
        if not words[u]:
            return low(w)
        return max(pairs[u, w] - d2[min(pairs[u, w], 3)], 0) / words[u] + sum(d2[min(c, 3)] for c in after[u]) / words[u] * low(w)

    if words:  # the model is a distribution over the known words and one unknown
        for u in list(words)[:20]:
            assert abs(sum(p(u, w) for w in [*words, b"\0unknown"]) - 1) < 1e-9
    out = []
    for d, t in rows:
        w = tokens(t)
        out.append((d, out_of(d), len(w), sum(words[x] > 0 for x in w), n, sum(math.log10((words[x] + 1) / (n + v + 1)) for x in w), sum(math.log10(p(u, x)) for u, x in zip([None] + w, w))))
    return sorted(out)


def run(spark, rows, **kw):
    got = score_held_out(spark.createDataFrame([(*r, 0.5, 1) for r in rows], SCHEMA), **kw).collect()
    return sorted((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got)


def same(a, b):
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert x[:5] == y[:5] and x[5:] == pytest.approx(y[5:], rel=1e-9, abs=1e-9)


def test_against_kneser_ney_by_hand(spark):
    rng = np.random.default_rng(2)
    text = lambda n: " ".join(("W%d" if x % 2 else "w%d") % (x // 2) for x in rng.zipf(1.3, n) % 300)
    rows = [(i, text(rng.integers(0, 200))) for i in range(150)]
    rows += [(200, None), (201, ""), (202, " \n"), (203, "unseen words only é"), (None, "no id"), (5, "repeated id w1 w2"), (204, "the the " * 9000)]
    same(run(spark, rows), expected(rows))


@pytest.mark.parametrize("rows", [[], [(9, "a b a"), (11, None)], [(d, "a b") for d in range(40) if zlib.crc32(str(d).encode()) % 7 == 2]])
def test_few_rows(spark, rows):
    same(run(spark, rows), expected(rows))


def test_held_out_beats_the_base(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = score_held_out(docs).filter("held_out").agg({"score": "sum", "base_score": "sum"}).first()
    assert got["sum(score)"] > got["sum(base_score)"]


def test_pair_keys_beyond_32_bits():
    """Ids above 2**32, own and frequent contexts, in buckets as large as any: keys lead back to their pairs."""
    from types import SimpleNamespace

    from textforge.llm.kneser_ney import PairKeys

    sizes = np.full(1 << 14, 1 << 20)  # 2**34 words
    words = SimpleNamespace(first=np.append(0, np.cumsum(sizes)), total=int(sizes.sum()))
    rng = np.random.default_rng(1)
    frequent = np.sort(rng.choice(words.total, 500, replace=False))
    keys = PairKeys(words, frequent)
    for b in (0, 5000, (1 << 14) - 1):
        low, high = int(words.first[b]), int(words.first[b + 1])
        u = np.append(rng.integers(low, high, 300), frequent[rng.integers(0, 500, 100)])
        w = rng.integers(0, words.total, 400)
        k = keys.join(b, u, w)
        back_u, back_w, own = keys.split(b, k)
        assert (back_u == u).all() and (back_w == w).all() and (own == ~np.isin(u, frequent)).all()
        assert len(np.unique(k)) == len({*zip(u.tolist(), w.tolist())})


def test_merged_pairs_are_held_few_times():
    import tracemalloc

    import numpy as np

    from textforge.llm.common import pack_arrays
    from textforge.llm.kneser_ney import PairKeys, Words, merged_pairs

    words = Words("", 0, [1 << 20])
    keys = PairKeys(words, np.zeros(0, np.int64))
    r = np.random.default_rng(1)
    payloads, want = [], {}
    for _ in range(8):
        u, w = np.sort(r.integers(0, 300, 100_000)), r.integers(0, 300, 100_000)
        payloads.append(pack_arrays(np.diff(u, prepend=0), w, np.full(len(u), 200)))
        for pair, n in zip(*np.unique(u * 300 + w, return_counts=True)):
            want[int(pair)] = want.get(int(pair), 0) + 200 * int(n)
    tracemalloc.start()
    pairs, c = merged_pairs(iter(payloads), keys, 0)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    u, w, _ = keys.split(0, pairs)
    assert dict(zip((u * 300 + w).tolist(), c.tolist())) == want  # sums beyond the counts' own type
    assert peak < 5 * 8 * 800_000  # ten arrays of all pairs before
