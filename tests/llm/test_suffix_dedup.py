import hashlib

import numpy as np
import pytest

import textforge.llm.suffix_dedup as S
from textforge.llm.suffix_dedup import dedup, front_code, front_decode, merge_runs

SCHEMA = "doc_id long, text string, n_bytes string, bucket int"


def expected(rows, length):
    rows = sorted(((d, (t or "").encode()) for d, t in rows if d is not None), key=lambda x: x[0])
    owner = {}
    for d, t in rows:
        for s in range(len(t) - length + 1):
            g = t[s : s + length]
            owner[g] = min((d, s), owner.get(g, (d, s)))
    out = []
    for d, t in rows:
        gone = np.zeros(len(t) + 1, bool)
        for s in range(len(t) - length + 1):
            if owner[t[s : s + length]] < (d, s):
                gone[s : s + length] = True
        kept = bytes(b for b, x in zip(t, gone) if not x)
        out.append((d, len(t), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest(), kept))
    return sorted(out)


def run(spark, rows, length, parts=3, **kw):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(parts)
    got = dedup(docs, length, with_text=True, **kw).collect()
    for r in got:
        assert sum(s.end - s.start for s in r.spans) == r.n_removed
    return sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in got)


def sample(seed):
    rng = np.random.default_rng(seed)
    text = lambda n, a="ab ": "".join(a[x] for x in rng.integers(0, len(a), n))
    rows = [(int(d), text(rng.integers(0, 150), "abcdefgh é\0")) for d in rng.permutation(60) - 20]
    passage, line = text(70, "abcdefgh"), text(22, "xyz")
    rows += [(100 + i, text(12, "abcdefgh") + passage[i % 3 :] + text(9, "abcdefgh")) for i in range(40)]
    rows += [(150 + i, text(40, "abcdefgh") + line + text(40, "abcdefgh") + line) for i in range(40)]
    base = text(400, "abcdefgh")
    for i in range(25):
        b = list(base)
        for p in rng.integers(0, 400, 6):
            b[p] = "#"
        rows.append((200 + i, "".join(b)))
    rows += [(300, None), (301, ""), (302, "a" * 300), (303, "ab" * 200), (304, text(500)), (100, "repeated id " + passage), (None, passage)]
    return rows


@pytest.mark.parametrize("seed,length,k,crowd", [(1, 20, 7, 2048), (2, 20, 7, 3), (3, 30, 12, 1), (4, 12, 11, 50)])
def test_against_brute_force(spark, seed, length, k, crowd):
    rows = sample(seed)
    assert run(spark, rows, length, k=k, crowd=crowd, bucket_bytes=2000) == expected(rows, length)


def test_long_text_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(S, "PIECE", 200)
    rows = sample(5) + [(400, "".join(t or "" for _, t in sample(5)))]
    assert run(spark, rows, 20, k=8) == expected(rows, 20)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(2, "abcdefghij"), (1, "abcdefghij"), (1, "abcdefghij")]])
def test_few_rows(spark, rows):
    assert run(spark, rows, 5, k=3) == expected(rows, 5)


def test_loser_tree_merges_front_coded_runs():
    rng = np.random.default_rng(9)
    words = [bytes(rng.integers(97, 99, rng.integers(1, 12)).tolist()) for _ in range(500)]
    for parts in (1, 2, 5, 8):
        runs = [sorted(words[i::parts]) for i in range(parts)]
        assert [x for r in runs for x, _ in front_decode(*front_code(r))] == [x for r in runs for x in r]
        last, out = b"", []
        for _, x, n in merge_runs([front_decode(*front_code(r)) for r in runs]):
            same = next((i for i, (a, b) in enumerate(zip(last, x)) if a != b), min(len(last), len(x)))
            assert n == same or not out
            out.append(x)
            last = x
        assert out == sorted(words)
