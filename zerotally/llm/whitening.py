"""Whitening of embeddings: pivoted Cholesky of the centred scatter, one-sided Jacobi on the triangular factor.

Entries become integers on a grid, so that the scatter is exact: one scan adds the vectors up, the next adds products of
the vectors centred on the integer next to their mean, and the fraction of the mean that is left is taken off the sums as
a whole number. Tasks fold their batches into one array of sums each; the driver sees sums of the size of the scatter
and never a vector. There the scatter C = L L' is factored with the largest remaining diagonal entry as pivot, which also
finds its rank, and Jacobi rotations make the columns of L orthogonal: their squared norms are the eigenvalues of C and
the columns over their norms its eigenvectors, with small eigenvalues as exact as large ones.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRID = 64
OFFSET = 1_000_000
COMPONENTS = 32
#: Grid values stay within this, greater entries stand at the bound: differences of two are exact as doubles.
BOUND = 1 << 52
#: Task sums that are brought to the driver at once; more are added up in tasks first.
DIRECT_SUMS = 128
SWEEPS = 60
LONG_MAX = (1 << 63) - 1


@dataclass(frozen=True)
class Whitening:
    """What a fit has found. `centre` is the integer next to the mean in every dimension, `rest` the sum of what is left."""
    n: int
    centre: tuple[int, ...]
    rest: tuple[int, ...]
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # one column per component
    explained: np.ndarray
    identity_error: float = math.nan


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, int]:
    """(vec_id, v) of the vectors that can be fitted, and their length: no null, no entry that is null or not finite, and
    the length that most such vectors have (of equally frequent ones the greatest)."""
    finite: Callable[[Column], Column] = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf)
    rows = (vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
            .where(F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", finite)))
    most = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = most["d"] if most else 0
    return rows.where(F.size("v") == d), d


def grid_values(batch: pa.RecordBatch, d: int) -> np.ndarray:
    """One row of whole numbers per vector, as doubles, that hold them exactly."""
    with np.errstate(over="ignore"):
        y = np.floor(batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, d) * GRID)
    return np.clip(y, -BOUND + OFFSET, BOUND - OFFSET) + OFFSET


def column_totals(x: np.ndarray) -> np.ndarray:
    """Sums of the columns as Python integers."""
    if float(np.abs(x).max()) * len(x) < 1 << 53:
        return x.sum(axis=0).astype(np.int64).astype(object)
    return np.array([sum(int(v) for v in column) for column in x.T], dtype=object)


def exact_products(y: np.ndarray) -> np.ndarray:
    """Y' Y as Python integers. Rows go through floating point in blocks whose sums stay below 2 ** 53."""
    total = np.zeros((y.shape[1],) * 2, dtype=object)
    size = np.abs(y).max(axis=1) if len(y) else np.zeros(0)
    small, big = y[size < 1 << 24], y[size >= 1 << 24]
    if len(small):
        step = int(min(1 << 16, (1 << 53) // max(1, int(np.abs(small).max()) ** 2)))
        for i in range(0, len(small), step):
            part = small[i:i + step]
            total += (part.T @ part).astype(np.int64)
    for row in big:
        whole = np.array([int(v) for v in row], dtype=object)
        total += np.outer(whole, whole)
    return total


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for value in batch.column(0):
            part = np.array([int(v) for v in value.as_py()], dtype=object)
            total = part if total is None else total + part
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([[str(v) for v in total]])], names=["sums"])


def whole_sums(rows: DataFrame, fold: Callable[[pa.RecordBatch], np.ndarray], size: int) -> list[int]:
    """Sum over all batches of arrays of Python integers, without loss."""
    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=object)
        for batch in batches:
            if batch.num_rows:
                total = total + fold(batch)
        yield pa.RecordBatch.from_arrays([pa.array([[str(v) for v in total]])], names=["sums"])

    tasks, sums = rows.rdd.getNumPartitions(), rows.mapInArrow(per_task, "sums array<string>")
    while tasks > DIRECT_SUMS:
        tasks = math.isqrt(tasks)
        sums = sums.repartition(tasks).mapInArrow(_added, "sums array<string>")
    total = np.zeros(size, dtype=object)
    for r in sums.toLocalIterator():
        total = total + np.array([int(v) for v in r["sums"]], dtype=object)
    return [int(v) for v in total]


def pivoted_cholesky(c: np.ndarray) -> np.ndarray:
    """L of full column rank with L L' = c for a positive semidefinite c; rows in the order of c. In the order of the
    pivots the factor is lower triangular."""
    left, d = c.copy(), len(c)
    least = 4 * d * np.finfo(c.dtype).eps * (c.diagonal().max() if d else 0)
    factor = np.zeros_like(c)
    free = np.ones(d, bool)
    for k in range(d):
        diagonal = np.where(free, left.diagonal(), -np.inf)
        p = int(np.argmax(diagonal))
        if not diagonal[p] > least:
            return factor[:, :k]
        column = np.where(free, left[:, p], 0) / np.sqrt(diagonal[p])
        factor[:, k], free[p] = column, False
        left -= np.outer(column, column)
    return factor


def orthogonal_columns(factor: np.ndarray) -> np.ndarray:
    """One-sided Jacobi: rotations of column pairs, d / 2 disjoint ones at a time, until all columns are orthogonal."""
    a, k = factor.copy(), factor.shape[1]
    order = list(range(k + k % 2))  # the last one is nobody where k is odd
    tolerance = max(1, len(a)) * np.finfo(a.dtype).eps
    for _ in range(SWEEPS):
        turned = False
        for _ in range(len(order) - 1):
            pairs = [(i, j) for i, j in zip(order[:len(order) // 2], reversed(order[len(order) // 2:])) if max(i, j) < k]
            order = [order[0], order[-1], *order[1:-1]]
            x, y = (np.array(side) for side in zip(*pairs)) if pairs else (np.zeros(0, int),) * 2
            u, v = a[:, x], a[:, y]
            uu, vv, uv = (u * u).sum(0), (v * v).sum(0), (u * v).sum(0)
            at = np.abs(uv) > tolerance * np.sqrt(uu * vv)
            if not at.any():
                continue
            turned = True
            x, y, u, v, uu, vv, uv = x[at], y[at], u[:, at], v[:, at], uu[at], vv[at], uv[at]
            zeta = (vv - uu) / (2 * uv)
            t = np.where(zeta < 0, -1, 1) / (np.abs(zeta) + np.hypot(1, zeta))
            cos = 1 / np.hypot(1, t)
            a[:, x], a[:, y] = cos * u - cos * t * v, cos * t * u + cos * v
        if not turned:
            return a
    raise ArithmeticError("the rotations did not settle")


def eigen(scatter: np.ndarray, n: int, components: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Eigenvalues of scatter / n ** 2, its eigenvectors and shares of the trace, the largest first."""
    trace = int(sum(scatter.diagonal()))
    if trace == 0:
        return np.zeros(0), np.zeros((len(scatter), 0)), np.zeros(0)
    shift = max(int(v).bit_length() for v in scatter.diagonal())
    wide = np.array([[np.longdouble(int(v)) for v in row] for row in scatter], dtype=np.longdouble)
    scale = np.ldexp(np.longdouble(1), -shift)
    a = orthogonal_columns(pivoted_cholesky(wide * scale))
    squares = (a * a).sum(0)
    order = np.argsort(-squares, kind="stable")[:components]
    squares, a = squares[order], a[:, order] / np.sqrt(squares[order])
    signs = np.sign(a[np.abs(a).argmax(axis=0), np.arange(a.shape[1])]) if a.shape[1] else 1
    values = squares / scale / np.longdouble(n) / np.longdouble(n)
    return values.astype(float), (a * signs).astype(float), (squares / (np.longdouble(trace) * scale)).astype(float)


def _upper(d: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(d)


def fit(rows: DataFrame, d: int, components: int = COMPONENTS) -> Whitening:
    """Components of all rows of `usable`."""
    n, *total = whole_sums(rows, lambda b: np.array([b.num_rows, *column_totals(grid_values(b, d))], dtype=object), d + 1)
    if n == 0:
        return Whitening(0, (), (), np.zeros(0), np.zeros((0, 0)), np.zeros(0))
    centre = [(2 * s + n) // (2 * n) for s in total]
    middle, upper = np.array(centre, float), _upper(d)
    found = whole_sums(rows, lambda b: exact_products(grid_values(b, d) - middle)[upper], len(upper[0]))
    rest = np.array([s - n * m for s, m in zip(total, centre)], dtype=object)
    scatter = np.zeros((d, d), dtype=object)
    scatter[upper] = found
    scatter = np.where(np.tri(d, k=-1, dtype=bool), scatter.T, scatter) * n - np.outer(rest, rest)
    values, vectors, explained = eigen(scatter, n, components)
    model = Whitening(n, tuple(centre), tuple(int(v) for v in rest), values, vectors, explained)
    return Whitening(**{**model.__dict__, "identity_error": _identity_error(rows, model, d)})


def projector(model: Whitening, d: int) -> Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray]]:
    """The centred grid values of a batch (on the integer centre) and its whitened coordinates."""
    centre, mean = np.array(model.centre, float), np.array([r / model.n for r in model.rest])
    scaled = model.vectors / np.sqrt(model.values)

    def run(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        y = grid_values(batch, d) - centre
        return y, (y - mean) @ scaled
    return run


def _identity_error(rows: DataFrame, model: Whitening, d: int) -> float:
    k = len(model.values)
    if k == 0:
        return 0.0
    run = projector(model, d)

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k + k * k)
        for batch in batches:
            if batch.num_rows:
                w = run(batch)[1]
                total += np.concatenate([w.sum(0), (w.T @ w).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array([total])], names=["sums"])

    place = rows.mapInArrow(per_task, "sums array<double>").select(F.posexplode("sums").alias("at", "s"))
    sums = np.array([r["s"] for r in place.groupBy("at").agg(F.sum("s").alias("s")).orderBy("at").collect()]) / model.n
    return float(np.abs(sums[k:].reshape(k, k) - np.outer(sums[:k], sums[:k]) - np.eye(k)).max())


def _deviations(y: np.ndarray, model: Whitening) -> pa.Array:
    """Sum over dimensions of (n x - S) ** 2, exact."""
    largest = model.n * (int(np.abs(y).max()) if y.size else 0) + max(abs(r) for r in model.rest)
    if y.shape[1] * largest ** 2 <= LONG_MAX:
        off = y.astype(np.int64) * model.n - np.array(model.rest, dtype=np.int64)
        return pa.array((off * off).sum(axis=1)).cast(pa.decimal128(38, 0))
    found = [sum((int(v) * model.n - r) ** 2 for v, r in zip(row, model.rest)) for row in y]
    return pa.array([v if v < 10 ** 38 else None for v in found], pa.decimal128(38, 0))


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per usable vector and component: vec_id, component (from 1), n, deviation (38 digits, null beyond them),
    whitened, explained, identity_error.

    The fit list is every usable vector (see `usable`); the others get no row. There are as many components as the
    covariance has rank, `components` at most: none for an empty table, a single vector or equal ones. Copies of a vector
    count and are returned each, whatever their ids, null ids too. Equal eigenvalues are numbered in the order in which
    the factor holds them. Grid values beyond 2 ** 52 stand there. Other columns are not looked at.
    """
    rows, d = usable(vectors, id_col, vector_col)
    model = fit(rows, d, components)
    k, head = len(model.values), rows.schema["vec_id"].dataType.simpleString()
    schema = (f"vec_id {head}, component int, n long, deviation decimal(38,0), whitened double, explained double, "
              "identity_error double")
    run = projector(model, d) if k else None

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            if not m or run is None:
                continue
            y, w = run(batch)
            each = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                 pa.array(np.full(m * k, model.n)), _deviations(y, model).take(each), pa.array(w.ravel()),
                 pa.array(np.tile(model.explained, m)), pa.array(np.full(m * k, model.identity_error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(out, schema)
