import math

import numpy as np
import pytest

from textforge.llm.whitening import refined_eigenvectors, whiten

SCHEMA = "vec_id long, embedding array<float>, label int, x string, n int"


def run(spark, rows, components=32):
    got = whiten(spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], SCHEMA).repartition(5), components)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    return got.collect()


def usable(rows):
    return [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]


def check(got, rows, k):
    """Against plain numpy, in Python's integers where the contract is exact."""
    kept = usable(rows)
    xs = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in kept]
    n, sums = len(xs), [sum(c) for c in zip(*xs)]
    x = np.array(xs, float) - np.array([s / n for s in sums])
    cov = x.T @ x / n
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1][:k], v[:, ::-1][:, :k]
    want = x @ v / np.sqrt(e)
    assert sorted((str(r.vec_id), r.component) for r in got) == sorted((str(i), c + 1) for i, _ in kept for c in range(k))
    assert {r.n for r in got} == {n}
    dev = {}
    for (i, _), row in zip(kept, xs):
        dev.setdefault(i, set()).add(sum((n * c - s) ** 2 for c, s in zip(row, sums)))
    assert all(r.deviation in dev[r.vec_id] for r in got)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    assert all(abs(r.explained - e[r.component - 1] / np.trace(cov)) < 1e-9 * r.explained for r in got)
    if len({i for i, _ in kept}) == len(kept):
        at = {i: p for p, (i, _) in enumerate(kept)}
        mine = np.zeros((n, k))
        for r in got:
            mine[at[r.vec_id], r.component - 1] = r.whitened
        sign = np.sign((mine * want).sum(axis=0))
        assert np.abs(mine * sign - want).max() < 1e-7


def vectors(n, d, seed, spread=None):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, d)) @ (rng.normal(size=(d, d)) * np.linspace(1, 0.1, d))
    return [(int(i), [float(c) for c in row]) for i, row in enumerate(base)]


def test_against_numpy(spark):
    rows = vectors(300, 40, 1) + [(900, None), (901, [None] * 40), (902, [float("nan")] + [0.0] * 39), (903, [1.0] * 39 + [float("inf")]), (904, [])]
    check(run(spark, rows), rows, 32)


def test_fewer_dimensions_than_components_and_repeated_rows(spark):
    rows = vectors(60, 7, 2)
    rows += rows[:25] + [(None, rows[3][1]), (7, rows[30][1])]
    check(run(spark, rows), rows, 7)


def test_fewer_rows_than_dimensions(spark):
    rows = vectors(6, 20, 3)
    got = run(spark, rows)
    assert {r.component for r in got} == {1, 2, 3, 4, 5}  # the centred rows have rank 5
    assert got[0].identity_error < 1e-9


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_no_variance(spark, rows):
    assert run(spark, rows) == []


def test_large_entries_leave_the_exact_path(spark):
    rows = [(i, [c * 1e9 for c in v]) for i, v in vectors(50, 5, 4)]
    got = run(spark, rows)
    assert len(got) == 250 and got[0].identity_error < 1e-6
    assert all(r.deviation is None for r in got)  # beyond 64 bits


def test_lengths_that_differ(spark):
    with pytest.raises(ValueError, match="different lengths"):
        run(spark, [(1, [1.0]), (2, [1.0, 2.0])])


@pytest.mark.parametrize("values", [
    np.linspace(1, 5, 30), np.logspace(0, -12, 30), np.r_[[1.0] * 10, [2.0] * 10, [3.0] * 10],
    np.r_[1 + 1e-9 * np.arange(10), 2 + 1e-13 * np.arange(10), 3 + 1e-6 * np.arange(10)], np.r_[np.zeros(20), 1e-8 * np.arange(1, 11)], np.zeros(5)])
def test_refinement_with_clustered_eigenvalues(values):
    """Double precision, clusters included: residual, orthogonality and eigenvalues, far below what float32 gives."""
    rng = np.random.default_rng(9)
    q = np.linalg.qr(rng.normal(size=(len(values), len(values))))[0]
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    size = max(np.abs(values).max(), 1e-300)
    e, x = refined_eigenvectors(a)
    assert np.abs(x.T @ x - np.eye(len(values))).max() < 1e-14
    assert np.abs(a @ x - x * e).max() < 2e-15 * len(values) * size
    assert np.abs(e - np.linalg.eigvalsh(a)[::-1]).max() < 1e-14 * size
    off = x.T @ a @ x
    assert np.abs(off - np.diag(np.diag(off))).max() < 2e-15 * len(values) * size


def test_refined_vectors_are_closer_than_those_of_float64():
    """Well separated eigenvalues of which the vectors are known to more than double precision."""
    rng = np.random.default_rng(3)
    a = rng.normal(size=(40, 40))
    a = a + a.T
    e, x = refined_eigenvectors(a)
    y = np.linalg.eigh(a)[1][:, ::-1]
    y = y * np.sign((x * y).sum(axis=0))
    wide = lambda v: np.abs(a.astype(np.longdouble) @ v.astype(np.longdouble) - v.astype(np.longdouble) * ((v.astype(np.longdouble) * (a.astype(np.longdouble) @ v.astype(np.longdouble))).sum(axis=0))).max()
    assert wide(x) <= 2 * wide(y) + 1e-15
