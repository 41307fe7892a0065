"""Whitening of embeddings: pivoted Cholesky and one-sided Jacobi.

Entries become integers on a fixed grid. One pass gives count and sums, a second the
scatter around the rounded mean, in integers that floating point holds exactly, so results
do not depend on the order of tasks; the rest of the centring follows exactly from the
sums. The covariance V is factored as V = L L' with complete pivoting, which stops where
nothing is left. One-sided Jacobi then rotates columns of L itself, pair by pair, until all
are orthogonal: their squared norms are the eigenvalues of V and the columns, normalised,
its components. A matrix with as many rows as dimensions is all that reaches the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sparrowscope.llm.common import Tables, map_texts

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32
# Partial matrices that one task adds up.
FAN_IN = 32
BATCH_VECTORS = 2048

# Entries beyond this have no place on the grid of long integers.
_LARGEST = 2.0**56
_LONG = 2**63 - 1


def valid_vectors(rows: DataFrame, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """id and grid (array of long) of the rows whose vector is neither null nor empty and
    holds finite entries only."""
    entries = F.transform(rows[vector], lambda c: c.cast("double"))

    def fits(c):  # NaN is larger than any number
        return F.coalesce(F.abs(c) <= F.lit(_LARGEST), F.lit(False))

    usable = F.forall(entries, fits)
    kept = rows.select(rows[id].alias("id"), entries.alias("entries"), (usable & (F.size(entries) > 0)).alias("usable"))
    # Spark may evaluate the grid before the filter.
    grid = F.transform("entries", lambda c: F.floor(F.when(fits(c), c) * F.lit(float(SCALE))) + F.lit(OFFSET))
    return kept.where("usable").select("id", grid.alias("grid"))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _added(parts: DataFrame) -> np.ndarray | None:
    """Sum of the matrices of all rows, FAN_IN of them to a task and round; the order does
    not matter as long as their entries are whole numbers."""
    tables = Tables(parts.sparkSession)
    parts = tables.store(parts, "partial-matrices")
    size = parts.count()
    while size > 1:
        size = math.ceil(size / FAN_IN)
        before, parts = parts, tables.store(map_texts(parts.repartition(size), _add_up, "matrix binary"), "partial-matrices")
        tables.drop(before)
    found = parts.collect()
    tables.drop(parts)
    return np.frombuffer(found[0]["matrix"], np.float64) if found else None


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for value in batch.column("matrix"):
            part = np.frombuffer(value.as_buffer(), np.float64)
            total = part.copy() if total is None else total + part
    if total is not None:
        yield pa.RecordBatch.from_pydict({"matrix": pa.array([total.tobytes()], pa.binary())})


def _partial(make):
    """One row per task with the sum of make(matrix of integers) over its batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = make(_matrix(batch.column("grid")))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_pydict({"matrix": pa.array([total.tobytes()], pa.binary())})

    return run


def pivoted_cholesky(matrix: np.ndarray, tolerance: float = 1e-14) -> np.ndarray:
    """L with matrix = L L' and as many columns as the matrix has rank: each column takes
    the largest diagonal entry that is left, until that is below `tolerance` of the first.
    Rows stay in place, so with the pivots as their order L is triangular."""
    size = len(matrix)
    left = np.diag(matrix).astype(np.float64).copy()
    columns: list[np.ndarray] = []
    taken = np.zeros(size, bool)
    floor = tolerance * size * max(left.max(initial=0.0), 0.0)
    for _ in range(size):
        pivot = int(np.argmax(np.where(taken, -np.inf, left)))
        if left[pivot] <= floor:
            break
        column = matrix[:, pivot].copy()
        if columns:
            done = np.stack(columns, 1)
            column -= done @ done[pivot]
        column[taken] = 0.0
        column /= math.sqrt(left[pivot])
        column[pivot] = math.sqrt(left[pivot])
        taken[pivot] = True
        left -= column**2
        columns.append(column)
    return np.stack(columns, 1) if columns else np.zeros((size, 0))


def _rounds(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Every pair of n columns once, in rounds of disjoint pairs."""
    seats = list(range(n + n % 2))
    out = []
    for _ in range(len(seats) - 1):
        half = len(seats) // 2
        pairs = [(a, b) for a, b in zip(seats[:half], seats[:half - 1:-1]) if max(a, b) < n]
        out.append((np.array([p[0] for p in pairs], int), np.array([p[1] for p in pairs], int)))
        seats = [seats[0], seats[-1], *seats[1:-1]]
    return out


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and eigenvectors (columns) of factor factor'. Pairs of columns
    are rotated until each is orthogonal to double precision."""
    a = np.array(factor, np.float64)
    rounds = _rounds(a.shape[1]) if a.shape[1] > 1 else []
    for _ in range(sweeps):
        turned = False
        for i, j in rounds:
            x, y = a[:, i], a[:, j]
            xx, yy, xy = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            turn = np.abs(xy) > 1e-15 * np.sqrt(xx * yy)
            if not turn.any():
                continue
            turned = True
            i, j, x, y, xx, yy, xy = i[turn], j[turn], x[:, turn], y[:, turn], xx[turn], yy[turn], xy[turn]
            zeta = (yy - xx) / (2 * xy)
            tangent = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1, zeta))
            cosine = 1 / np.hypot(1, tangent)
            sine = cosine * tangent
            a[:, i], a[:, j] = cosine * x - sine * y, sine * x + cosine * y
        if not turned:
            break
    norms = np.sqrt((a * a).sum(0))
    order = np.argsort(-norms, kind="stable")
    order = order[norms[order] > 0]
    return norms[order] ** 2, a[:, order] / norms[order]


@dataclass(frozen=True)
class Whitening:
    """n vectors with per-dimension sums; eigenvalues and components (columns) of their
    covariance, whose trace is `trace`; identity_error once measured."""

    n: int
    sums: tuple[int, ...]
    eigenvalues: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float = 0.0

    def _from_mean(self, grid: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """Distance from the whole part of the mean, and the remainders of the sums."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        return grid - whole, [s % self.n for s in self.sums]

    def project(self, grid: np.ndarray) -> np.ndarray:
        """Whitened coordinates of vectors on the grid."""
        whole, rest = self._from_mean(grid)
        centred = whole.astype(np.float64) - np.array([r / self.n for r in rest])
        return centred @ self.components / np.sqrt(self.eigenvalues)

    def deviations(self, grid: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S) squared, exact; null beyond a long."""
        whole, rest = self._from_mean(grid)
        largest = self.n * (int(np.abs(whole).max(initial=0)) + 1)
        if grid.shape[1] * largest**2 > _LONG:
            exact = ((self.n * whole.astype(object) - np.array(rest, object)) ** 2).sum(1)
            return [value if value <= _LONG else None for value in map(int, exact)]
        return ((self.n * whole - np.array(rest, np.int64)) ** 2).sum(1).tolist()


def _of_length(vectors: DataFrame) -> tuple[int, DataFrame]:
    """The most frequent length (the largest of several) and the vectors that have it."""
    counts = vectors.groupBy(F.size("grid").alias("d")).count()
    first = counts.orderBy(F.desc("count"), F.desc("d")).first()
    if first is None:
        return 0, vectors
    return first["d"], vectors.where(F.size("grid") == first["d"])


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Whitening of all `vectors` (id, grid), which have one length; None if there are
    none. Directions without variance have no component, so there may be fewer."""
    # Sums go through JVM longs as decimals: exact at any size.
    sums = vectors.select(F.posexplode("grid").alias("i", "x")).groupBy("i").agg(
        F.sum(F.col("x").cast("decimal(38,0)")).alias("s"), F.count(F.lit(1)).alias("n")
    )
    rows = sorted(sums.collect())
    if not rows:
        return None
    n, totals = rows[0]["n"], tuple(int(r["s"]) for r in rows)
    centre = np.array([round(s / n) if abs(s) < 2**52 else s // n for s in totals], np.int64)

    def scatter(grid: np.ndarray) -> np.ndarray:
        d = (grid - centre).astype(np.float64)
        return (d.T @ d).ravel()

    found = _added(map_texts(vectors.select("grid"), _partial(scatter), "matrix binary", BATCH_VECTORS))
    size = len(totals)
    # What the rounded centre left: less than one step of the grid.
    rest = np.array([(s - n * int(c)) / n for s, c in zip(totals, centre)])
    covariance = found.reshape(size, size) / n - np.outer(rest, rest)
    values, vectors_ = one_sided_jacobi(pivoted_cholesky(covariance))
    k = min(components, len(values))
    model = Whitening(n, totals, values[:k], vectors_[:, :k], float(np.trace(covariance)))

    def moments(grid: np.ndarray) -> np.ndarray:
        w = model.project(grid)
        return np.concatenate([w.sum(0), (w.T @ w).ravel()])

    if k == 0:
        return model
    found = _added(map_texts(vectors.select("grid"), _partial(moments), "matrix binary", BATCH_VECTORS))
    mean, second = found[:k] / n, found[k:].reshape(k, k) / n
    error = float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())
    return Whitening(n, totals, model.eigenvalues, model.components, model.trace, error)


def whiten(rows: DataFrame, id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Per remaining row and component (from 1, by falling eigenvalue): id, component, n,
    deviation, whitened, explained and identity_error.

    Rows drop out whose vector is null or empty, holds a null, NaN or infinite entry (or
    one beyond 2 ** 56), or has another length than most. Repeated rows count, and have
    their own result each; a null id is kept. Without remaining rows, or without any
    variance, the result is empty. Other columns are not read.
    """
    length, vectors = _of_length(valid_vectors(rows, id, vector))
    kind = rows.schema[id].dataType.simpleString()
    schema = f"`{id}` {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    model = fit(vectors, components) if length else None
    if model is None or len(model.eigenvalues) == 0:
        return rows.sparkSession.createDataFrame([], schema)
    return _applied(vectors, model, id, schema)


def _applied(vectors: DataFrame, model: Whitening, id: str, schema: str) -> DataFrame:
    k = len(model.eigenvalues)
    explained = model.eigenvalues / model.trace

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count = batch.num_rows
            if not count:
                continue
            grid = _matrix(batch.column("grid"))
            each = np.repeat(np.arange(count), k)
            deviation = pa.array(model.deviations(grid), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), count)),
                    pa.array(np.full(count * k, model.n, np.int64)),
                    deviation.take(pa.array(each)),
                    pa.array(model.project(grid).ravel()),
                    pa.array(np.tile(explained, count)),
                    pa.array(np.full(count * k, model.identity_error)),
                ],
                [id, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return map_texts(vectors, make, schema, BATCH_VECTORS)
