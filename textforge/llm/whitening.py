"""Embedding whitening by mixed-precision refinement.

The covariance is a distributed sum; its eigenvectors are found in float32 and corrected by Ogita and Aishima's iterations, which
are matrix products in higher precision.

1. Entries become integers, x = floor(64 c) + 1000000. One pass gives n, each dimension's sum, least and greatest x.
2. A second pass centres each vector at the integer nearest to its dimension's mean before multiplying, and adds up the
   products. Blocks are multiplied in float64 as long as their products are whole numbers below 2^53, then added as 64-bit
   integers, so the sum does not depend on how rows are dealt out or on repeated tasks; what the integer centre is off the
   mean is taken out exactly. Each entry of the covariance is the double nearest to its true value. (With entries so large
   that this does not hold, the pass centres at the mean and adds doubles.) Tasks' sums meet in a tree of fan-in 32.
3. Only the matrix of dimension x dimension reaches the driver; it does not grow with the rows (``most_dimensions`` bounds it).
   Float32 eigenvectors X are refined: with R = I - X'X and S = X'AX, eigenvalues are S_ii / (1 - R_ii), and X becomes X + XE,
   where E_ij = (S_ij + l_j R_ij) / (l_j - l_i), or R_ij / 2 for eigenvalues closer than the current error. Such a cluster is
   then solved by itself: A, shifted by the cluster's centre and projected on its vectors, gives the rotation within it. The
   last iterations run in extended precision (up to ``most_extended`` dimensions).
4. A third pass projects; the whitened vectors are written once, and two passes over them give the covariance that they
   really have, centred at the mean that they really have.

Defined cases: rows whose vector is null, empty, or holds null or non-finite entries are dropped. Vectors of different lengths
cannot be whitened together and raise an error; an entry beyond 64-bit integers raises Spark's overflow error. Repeated rows
and null ids count and are returned as often as they stand. Components without variance (eigenvalue at most dimension * 2^-52 of
the largest) cannot be whitened and are left out, so equal vectors, one vector, or no vector give no rows. Equal eigenvalues
have any orthonormal vectors of their space, the same for all rows; each vector's sign makes its largest entry positive. A
deviation beyond a 64-bit integer is null. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textforge._ship import by_value
from textforge.session import materialize

by_value(__name__)

FAN_IN = 32
BLOCK = 4096
SUMS = "n long, sums array<decimal(38,0)>, least array<long>, most array<long>"
RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and x (array of long) of the rows that can be used."""
    v = F.col("v")
    good = v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    picked = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).filter(F.coalesce(good, F.lit(False)))
    return picked.select("vec_id", F.transform("v", lambda c: F.floor(64 * c).cast("long") + 1_000_000).alias("x"))


def matrix_of(column: pa.Array, dtype=np.int64) -> np.ndarray:
    """Rows of a list column as a matrix; all have the same length."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(dtype, copy=False) if len(column) else np.zeros((0, 0), dtype)


def tree_sum(parts: DataFrame, kind: str) -> np.ndarray | None:
    """Sum of the arrays in the rows of ``parts`` (payload binary, of the dtype ``kind``), added up by tasks in a tree."""
    def add(batches):
        total = None
        for batch in batches:
            for x in batch.column("payload"):
                y = np.frombuffer(x.as_py(), kind)
                total = y.copy() if total is None else total + y
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["payload"])

    n = parts.rdd.getNumPartitions()
    while n > 1:
        n = -(-n // FAN_IN)
        parts = parts.repartition(n).mapInArrow(add, "payload binary")
    rows = parts.collect()  # one
    return sum(np.frombuffer(r.payload, kind) for r in rows) if rows else None


class Fit(NamedTuple):
    n: int
    sums: list[int]       # of x, by dimension
    centre: np.ndarray    # integers nearest to the means
    values: np.ndarray    # eigenvalues, falling
    vectors: np.ndarray   # columns
    trace: float


def sums_of(vectors: DataFrame) -> tuple[int, list[int], list[int], list[int]]:
    """n, and each dimension's sum, least and greatest x."""
    shape = vectors.agg(F.min(F.size("x")).alias("least"), F.max(F.size("x")).alias("most")).first()
    if shape.least is None:
        return 0, [], [], []
    if shape.least != shape.most:
        raise ValueError(f"vectors of different lengths: {shape.least} to {shape.most}")

    def add(batches):
        n, total, least, most = 0, None, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix_of(batch.column("x"))
            if n == 0:
                total, least, most = [0] * x.shape[1], x.min(axis=0), x.max(axis=0)
            least, most = np.minimum(least, x.min(axis=0)), np.maximum(most, x.max(axis=0))
            safe = max(abs(int(x.min())), abs(int(x.max()))) * len(x) < 1 << 62
            n += len(x)
            total = [a + int(b) for a, b in zip(total, (x if safe else x.astype(object)).sum(axis=0))]
        if n:
            import decimal
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([[decimal.Decimal(t) for t in total]], pa.list_(pa.decimal128(38, 0))),
                                              pa.array([least.tolist()], pa.list_(pa.int64())), pa.array([most.tolist()], pa.list_(pa.int64()))], names=["n", "sums", "least", "most"])

    parts = vectors.select("x").mapInArrow(add, SUMS).select("n", F.posexplode(F.arrays_zip("sums", "least", "most")).alias("i", "z"))
    rows = parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum("z.sums").cast("decimal(38,0)").alias("s"), F.min("z.least").alias("least"), F.max("z.most").alias("most")).orderBy("i").collect()  # one for each dimension
    return rows[0].n, [int(r.s) for r in rows], [r.least for r in rows], [r.most for r in rows]


def covariance(vectors: DataFrame, n: int, sums: list[int], centre: list[int], reach: int) -> np.ndarray:
    """Covariance of x, divisor n; ``reach`` is the largest distance of an x from the centre."""
    d, middle = len(sums), np.array(centre, np.int64)
    rest = [s - n * c for s, c in zip(sums, centre)]  # sums of the centred vectors
    exact = reach < 1 << 20 and n * reach * reach < 1 << 62
    off = np.array([float(r) / n for r in rest])

    def multiply(batches):
        total = np.zeros((d, d), np.int64 if exact else np.float64)
        for batch in batches:
            x = matrix_of(batch.column("x"))
            for at in range(0, len(x), BLOCK):
                y = (x[at : at + BLOCK] - middle).astype(np.float64)
                if not exact:
                    y -= off
                g = y.T @ y
                total += g.astype(np.int64) if exact else g
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["payload"])

    total = tree_sum(vectors.select("x").mapInArrow(multiply, "payload binary"), "i8" if exact else "f8").reshape(d, d)
    if not exact:
        return (total + total.T) / (2 * n)
    out = np.empty((d, d))
    for i in range(d):
        for j in range(i + 1):  # Python's division of integers gives the nearest double
            out[i, j] = out[j, i] = (n * int(total[i, j]) - rest[i] * rest[j]) / (n * n)
    return out


# ---------------------------------------------------------------- eigenvectors
def products(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.eye(len(a), dtype=x.dtype) - x.T @ x, x.T @ (a @ x)


def correct(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """One iteration: better vectors, the eigenvalues, which pairs of them count as clustered, and the size of the correction.

    A pair is clustered if its distance is not above the error that the products bound, or too small for the step to be a
    correction; only its orthogonality is corrected then."""
    r, s = products(a, x)
    values = np.diag(s) / (1 - np.diag(r))
    off = s - np.diag(np.diag(s))
    near = 2 * (np.abs(off).sum(axis=0).max() + np.abs(values).max() * np.abs(r).sum(axis=0).max())
    gap = values[None, :] - values[:, None]
    step = s + values[None, :] * r
    close = (np.abs(gap) <= near) | (np.abs(step) > 0.01 * np.abs(gap))
    e = np.where(close, r / 2, step / np.where(close, 1, gap))
    np.fill_diagonal(close, False)
    return x + x @ e, values, close, float(np.abs(e).max())


def clusters(values: np.ndarray, close: np.ndarray) -> list[np.ndarray]:
    """Index sets of eigenvalues that clustered pairs hold together: runs in the order of the values."""
    order = np.argsort(values)
    pairs = close[np.ix_(order, order)]
    last = np.where(pairs.any(axis=1), len(values) - 1 - np.argmax(pairs[:, ::-1], axis=1), 0)
    reach = np.maximum.accumulate(np.maximum(last, np.arange(len(values))))
    cuts = np.flatnonzero(reach[:-1] <= np.arange(len(values) - 1)) + 1
    return [g for g in np.split(order, cuts) if len(g) > 1]


def refined_eigenvectors(a: np.ndarray, sweeps: int = 12, most_extended: int = 1024) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and eigenvectors of a symmetric matrix: float32 start, corrected in higher precision."""
    scale = float(np.abs(a).max()) or 1.0
    a = a / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.float64)
    for kind in [np.float64, np.longdouble] if len(a) <= most_extended else [np.float64]:
        a, x = a.astype(kind), x.astype(kind)
        for _ in range(sweeps):
            x, values, close, change = correct(a, x)
            for g in clusters(values, close):
                # shifted by the cluster's centre, its differences are not lost beside its size
                shifted = x[:, g].T @ (a @ x[:, g] - values[g].mean() * x[:, g])
                x[:, g] = x[:, g] @ np.linalg.eigh(((shifted + shifted.T) / 2).astype(np.float64))[1].astype(kind)
            if change < 4 * np.finfo(kind).eps:
                break
    for _ in range(2):  # rotations within clusters are orthogonal to double precision only
        r, s = products(a, x)
        x = x + x @ (r / 2)
    values = np.diag(s) / (1 - np.diag(r))
    order = np.argsort(-values, kind="stable")
    x = x[:, order] / np.sqrt((x[:, order] ** 2).sum(axis=0))
    x = x * np.where(x[np.abs(x).argmax(axis=0), np.arange(x.shape[1])] < 0, -1, 1)
    return (values[order] * scale).astype(np.float64), x.astype(np.float64)


def fit(vectors: DataFrame, components: int, most_dimensions: int = 4096) -> Fit | None:
    n, sums, least, most = sums_of(vectors)
    if not n:
        return None
    if len(sums) > most_dimensions:
        raise ValueError(f"{len(sums)} dimensions; the covariance of at most {most_dimensions} is solved on the driver")
    centre = [(2 * s + n) // (2 * n) for s in sums]
    reach = max(max(h - c, c - l) for h, c, l in zip(most, centre, least))
    v = covariance(vectors, n, sums, centre, reach)
    values, x = refined_eigenvectors(v)
    k = min(components, int((values > len(sums) * 2.0**-52 * max(values[0], 0.0)).sum()))
    return Fit(n, sums, np.array(centre, np.int64), values[:k], x[:, :k], float(np.trace(v)))


# ---------------------------------------------------------------- projection
def projected(vectors: DataFrame, fitted: Fit) -> DataFrame:
    """vec_id, deviation and whitened (array) of every vector."""
    n, centre = fitted.n, fitted.centre
    rest = [s - n * int(c) for s, c in zip(fitted.sums, centre)]
    off, side = np.array([float(r) / n for r in rest]), fitted.vectors / np.sqrt(fitted.values)
    k, d = side.shape[1], len(rest)

    def deviations(y: np.ndarray) -> pa.Array:
        most = n * max(abs(int(y.min())), abs(int(y.max()))) + max(map(abs, rest))
        if d * most * most < 1 << 63:
            z = n * y - np.array(rest, np.int64)
            return pa.array((z * z).sum(axis=1), pa.int64())
        z = n * y.astype(object) - np.array(rest, object)
        return pa.array([t if t < 1 << 63 else None for t in (z * z).sum(axis=1)], pa.int64())

    def project(batches):
        for batch in batches:
            if batch.num_rows:
                y = matrix_of(batch.column("x")) - centre
                w = (y - off) @ side
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, w.size + 1, k, dtype=np.int32)), pa.array(w.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), deviations(y), lists], names=["vec_id", "deviation", "whitened"])

    return vectors.mapInArrow(project, "vec_id long, deviation long, whitened array<double>")


def identity_error(whitened: DataFrame, n: int, k: int) -> float:
    """Largest entry, without sign, of the whitened vectors' covariance minus the identity."""
    def add(batches):
        total = np.zeros(k)
        for batch in batches:
            if batch.num_rows:
                total += matrix_of(batch.column("whitened"), np.float64).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["payload"])

    mean = tree_sum(whitened.select("whitened").mapInArrow(add, "payload binary"), "f8") / n

    def multiply(batches):
        total = np.zeros((k, k))
        for batch in batches:
            if batch.num_rows:
                y = matrix_of(batch.column("whitened"), np.float64) - mean
                total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["payload"])

    got = tree_sum(whitened.select("whitened").mapInArrow(multiply, "payload binary"), "f8").reshape(k, k) / n
    return float(np.abs(got - np.eye(k)).max())


def whiten(rows: DataFrame, components: int = 32, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A row for each usable vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = rows.sparkSession
    vectors = integer_vectors(rows, id_col, vector_col)
    fitted = fit(vectors, components)
    if fitted is None or not len(fitted.values):
        return spark.createDataFrame([], T.StructType.fromDDL(RESULT))
    whitened = materialize(projected(vectors, fitted), "whitened")
    error = identity_error(whitened, fitted.n, len(fitted.values))
    shares = F.array(*[F.lit(float(e) / fitted.trace) for e in fitted.values])
    out = whitened.select("vec_id", "deviation", F.posexplode("whitened").alias("i", "whitened"))
    return out.select("vec_id", (F.col("i") + 1).alias("component"), F.lit(fitted.n).cast("long").alias("n"), "deviation", "whitened",
                      F.element_at(shares, F.col("i") + 1).alias("explained"), F.lit(error).alias("identity_error"))
