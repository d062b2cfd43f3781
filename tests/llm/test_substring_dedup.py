import hashlib

import numpy as np
import pytest

from textforge.llm.common import Sketch, mix
from textforge.llm.substring_dedup import dedup

SCHEMA = "doc_id long, text string, n_words string, bucket int"


def expected(rows, window):
    rows = [(d, (t or "").encode().split()) for d, t in rows if d is not None]
    owner = {}
    for d, w in rows:
        for s in range(len(w) - window + 1):
            g = tuple(w[s : s + window])
            owner[g] = min(d, owner.get(g, d))
    out = []
    for d, w in rows:
        gone = {p for s in range(len(w) - window + 1) if owner[tuple(w[s : s + window])] < d for p in range(s, s + window)}
        kept = b" ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest(), kept.decode()))
    return sorted(out)


def run(spark, rows, window, **kw):
    got = dedup(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3), window, True, **kw).collect()
    for r in got:
        assert sum(s.end - s.start for s in r.spans) == r.n_removed
    return sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.text) for r in got)


def test_against_brute_force(spark):
    rng = np.random.default_rng(4)
    text = lambda n: " ".join("abc"[x] for x in rng.integers(0, 3, n))
    rows = [(int(d), text(rng.integers(0, 60))) for d in rng.permutation(90) - 20]
    passage = text(25)
    rows += [(100 + i, f"x{i} {passage}\n\ty{i}") for i in range(20)]
    rows += [(200, None), (201, ""), (202, " \x0b "), (203, "é " * 9000), (204, "é " * 30), (100, "repeated id " + passage), (None, passage), (205, passage.upper())]
    assert run(spark, rows, 8) == expected(rows, 8)
    assert run(spark, rows, 20, bucket_windows=50) == expected(rows, 20)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(2, "a b c"), (1, "a b c d")]])
def test_few_rows(spark, rows):
    assert run(spark, rows, 3) == expected(rows, 3)


def test_sketch_never_underestimates(spark, tmp_dir):
    import pyarrow as pa

    rng = np.random.default_rng(8)
    once, twice = mix(np.arange(1, 4001, dtype=np.uint64)), mix(np.arange(10_000, 10_500, dtype=np.uint64))
    sketch = Sketch.sized(tmp_dir, 4500, 2)
    rows = [x for part in np.array_split(rng.permutation(once), 5) for x in sketch.counted(np.concatenate([part, twice]))]
    present = []
    for b in sorted({b for b, _ in rows}):
        sketch.merge(pa.table({"bucket": pa.array([b] * sum(c == b for c, _ in rows), pa.int32()), "payload": pa.array([p for c, p in rows if c == b], pa.binary())}))
        present.append(b)
    files = sketch.open(present)
    assert sketch.repeated(files, twice).all()
    assert sketch.repeated(files, once).mean() < 0.2
