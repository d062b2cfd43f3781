import hashlib
import re
import struct
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from textforge.llm.order_minhash import fingerprint_edits

SCHEMA = "doc_id long, text string, fp string, place int, copy int"


def h64(data, seed):
    return xxhash.xxh64_intdigest(data, seed)


def omh(text, bits=6, size=2):
    """Order MinHash by hand: components {bucket: hash}."""
    w = [x.encode() for x in re.split("[ \t-\r]+", text) if x]
    seen, buckets = Counter(), defaultdict(list)
    for p in range(len(w)):
        k = h64(w[p], 42)
        if p + 1 < len(w):
            k = h64(w[p + 1], k)
        n, seen[k] = seen[k], seen[k] + 1
        h = h64(struct.pack("<i", n), h64(struct.pack("<Q", k), 42))
        buckets[h >> (64 - bits)].append((h - (1 << 64) if h >> 63 else h, p))
    out = {}
    for b, kmers in buckets.items():
        seed = 42
        for h, _ in sorted(sorted(kmers)[:size], key=lambda x: x[1]):
            seed = h64(struct.pack("<q", h), seed)
        out[b] = (b << (32 - bits)) | (seed >> (32 + bits))
    return out


def like(a, b):
    either = a.keys() | b.keys()
    return sum(a.get(x) == b.get(x) for x in either) / len(either) if either else 1.0


def expected(rows):
    rows = sorted((d, t or "") for d, t in rows if d is not None)
    out = []
    for i, (d, t) in enumerate(rows):
        nxt = rows[i - 1][1]  # the next smaller id; the last one's next is the largest
        cut = len(t) // 3
        e = t[: len(t) - cut] + nxt[:cut]
        text = lambda f: "".join(f"{x:08X}" for _, x in sorted(f.items(), key=lambda y: y[0]))
        out.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), text(omh(t)), text(omh(e)), round(like(omh(t), omh(e)), 9), round(like(omh(t), omh(nxt)), 9)))
    return sorted(out)


def run(spark, rows):
    got = fingerprint_edits(spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)).collect()
    return sorted((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9)) for r in got)


def test_against_order_minhash_by_hand(spark):
    rng = np.random.default_rng(3)
    text = lambda n: " ".join("w%d" % x for x in rng.zipf(1.5, n) % 400)
    rows = [(int(x), text(rng.integers(0, 300))) for x in rng.choice(10_000, 60, replace=False)]
    rows += [(20_000, None), (20_001, ""), (20_002, " \n\t"), (20_003, "one"), (20_004, "a a a a a b a a"), (20_005, "é\x0bü 日本語"), (20_006, text(20_000)), (None, "no id"), (20_004, "repeated id"), (20_003, "one")]
    assert run(spark, rows) == expected(rows)


@pytest.mark.parametrize("rows", [[], [(5, "only one row")], [(None, "x")]])
def test_few_rows(spark, rows):
    assert run(spark, rows) == expected(rows)


def test_order_matters_and_equal_texts_are_equal(spark):
    words = ["t%d" % i for i in range(200)]
    rows = {r[0]: r for r in run(spark, [(1, " ".join(words)), (2, " ".join(words)), (3, " ".join(words[100:] + words[:100])), (4, " ".join(sorted(words)))])}
    assert rows[1][3] == rows[2][3] and rows[2][6] == 1.0
    assert 0.3 < rows[3][6] < 1.0  # same pairs of words but one, in another order
