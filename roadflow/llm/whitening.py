"""Embedding whitening by pivoted Cholesky and one-sided Jacobi.

Vectors are put on an integer grid, x = floor(64 c) + 1000000. The fit takes
each distinct grid vector once: a first pass gives their number n and exact
sums S, a second the scatter of the centred vectors, summed by task and then
by entry. The scatter (dimension x dimension, whatever the number of rows) is
factored on the driver: pivoted Cholesky, then one-sided Jacobi rotations of
the columns of the triangular factor until they are orthogonal. The squared
column norms are the eigenvalues of the scatter, the normalised columns its
eigenvectors: the components. Vectors are projected on them in the tasks.

Centring is exact up to the last rounding: with q = S div n and s = S mod n,
x - S/n = (x - q) - s/n, where x - q is an integer.

Defined results: rows whose vector is null, or holds a null, a NaN, an infinity
or a number of 2^40 or more, are dropped. So are vectors of another length than
most distinct vectors have (of equally frequent lengths the longest counts), and
empty ones. Components without variance (a pivot within rounding of zero) are
not returned, so equal vectors, and a single one, have none. Repeated rows are
each projected, and count once in the fit. An empty table has no components.
Of the two signs of a component the one is taken whose largest entry (the first
of equal ones) is positive. ``deviation`` is null beyond a long. Extra columns
pass through.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, materialise, small_arrow_batches

SCALE, SHIFT = 64, 1_000_000
LARGEST = float(1 << 40)
COMPONENTS = 16
#: A pivot under this share of the largest one is rounding, not variance.
RANK = 1e-12
SWEEPS = 60


def grid(vector: Column) -> Column:
    """The integer vector, or null for one that is dropped."""
    good = F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < LARGEST))
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + F.lit(SHIFT).cast("long"))
    return F.when(good & (F.size(vector) > 0), x)


# --------------------------------------------------------------------------
# Factoring
# --------------------------------------------------------------------------

def pivoted_cholesky(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(L, order): matrix[order][:, order] = L L^T with as many columns as the matrix has rank."""
    a = matrix.copy()
    d = len(a)
    order = np.arange(d)
    factor = np.zeros((d, d))
    largest = a.diagonal().max(initial=0.0)
    for k in range(d):
        p = k + int(np.argmax(a.diagonal()[k:]))
        if a[p, p] <= RANK * largest:
            return factor[:, :k], order
        for m in (a, a.T, factor):
            m[[k, p]] = m[[p, k]]
        order[[k, p]] = order[[p, k]]
        factor[k, k] = np.sqrt(a[k, k])
        factor[k + 1:, k] = a[k + 1:, k] / factor[k, k]
        a[k + 1:, k + 1:] -= np.outer(factor[k + 1:, k], factor[k + 1:, k])
    return factor, order


def disjoint_pairs(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Every pair of 0..n-1 once, in rounds whose pairs share no member."""
    ring = list(range(n + n % 2))
    out = []
    for _ in range(len(ring) - 1):
        half = len(ring) // 2
        pairs = [(i, j) for i, j in zip(ring[:half], reversed(ring[half:])) if max(i, j) < n]
        out.append(tuple(np.array(side, int) for side in zip(*pairs)))
        ring = [ring[0], ring[-1], *ring[1:-1]]
    return out


def jacobi(factor: np.ndarray) -> np.ndarray:
    """The factor with its columns rotated until they are orthogonal to each other."""
    g = factor.copy()
    rounds = disjoint_pairs(g.shape[1]) if g.shape[1] > 1 else []
    for _ in range(SWEEPS):
        rotated = False
        for i, j in rounds:
            left, right = g[:, i], g[:, j]
            a, b, c = (left * left).sum(axis=0), (right * right).sum(axis=0), (left * right).sum(axis=0)
            turn = np.abs(c) > 1e-15 * np.sqrt(a * b)
            if not turn.any():
                continue
            rotated = True
            zeta = np.where(turn, b - a, 1.0) / np.where(turn, 2 * c, 1.0)
            t = np.where(turn, np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta)), 0.0)
            cos = 1 / np.hypot(1.0, t)
            g[:, i], g[:, j] = cos * (left - t * right), cos * (t * left + right)
        if not rotated:
            break
    return g


def eigen(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, eigenvectors as columns) of the part of the scatter that has variance."""
    factor, order = pivoted_cholesky(scatter)
    g = jacobi(factor)
    norms = np.linalg.norm(g, axis=0)
    by_size = np.argsort(-norms, kind="stable")
    vectors = np.empty_like(g)
    vectors[order] = g / norms
    vectors = vectors[:, by_size]
    largest = np.abs(vectors).argmax(axis=0)
    return norms[by_size] ** 2, vectors * np.sign(vectors[largest, np.arange(vectors.shape[1])])


# --------------------------------------------------------------------------
# Passes over the distinct vectors
# --------------------------------------------------------------------------

def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dimension)


def sums_of(batches: Iterable[pa.RecordBatch], dimension: int) -> Iterator[pa.RecordBatch]:
    """Each dimension's exact sum over a task, in two halves that cannot overflow."""
    high, low = np.zeros(dimension, np.int64), np.zeros(dimension, np.int64)
    for batch in batches:
        x = _matrix(batch.column(0), dimension)
        high += (x >> 24).sum(axis=0)
        low += (x & 0xFFFFFF).sum(axis=0)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(dimension), pa.int32()), pa.array(high), pa.array(low)],
                                     ["at", "high", "low"])


def entries(square: np.ndarray) -> pa.RecordBatch:
    """The upper triangle of a symmetric matrix as rows."""
    i, j = np.triu_indices(len(square))
    return pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(square[i, j])],
                                      ["i", "j", "v"])


@dataclass
class Whitening:
    """The fit: n and S of the distinct vectors, components (columns) and what they explain."""

    dimension: int
    n: int = 0
    sums: list[int] = field(default_factory=list)
    values: np.ndarray = field(default_factory=lambda: np.empty(0))  # eigenvalues of the covariance
    vectors: np.ndarray = field(default_factory=lambda: np.empty((0, 0)))
    explained: np.ndarray = field(default_factory=lambda: np.empty(0))
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        return (x - whole).astype(np.float64) - rest

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)


def scatter_of(batches: Iterable[pa.RecordBatch], model: Whitening) -> Iterator[pa.RecordBatch]:
    total = np.zeros((model.dimension, model.dimension))
    for batch in batches:
        y = model.centred(_matrix(batch.column(0), model.dimension))
        total += y.T @ y
    yield entries(total)


def whitened_scatter_of(batches: Iterable[pa.RecordBatch], model: Whitening) -> Iterator[pa.RecordBatch]:
    """The scatter of the whitened vectors, bordered by their sums."""
    k = len(model.values)
    total = np.zeros((k + 1, k + 1))
    for batch in batches:
        z = model.whitened(_matrix(batch.column(0), model.dimension))
        z = np.hstack([z, np.ones((len(z), 1))])
        total += z.T @ z
    yield entries(total)


def _summed(parts: DataFrame, size: int) -> np.ndarray:
    """Entries added over the tasks (map-side combined); the square goes to the driver, whose size is the dimension's."""
    out = np.zeros((size, size))
    for i, j, v in parts.groupBy("i", "j").agg(F.sum("v")).collect():
        out[i, j] = out[j, i] = v
    return out


def fit(rows: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """Components of the distinct grid vectors of ``rows``."""
    small_arrow_batches(rows.sparkSession)
    x = materialise(rows.select(grid(F.col(vector_col)).alias("x")).filter("x is not null").distinct(), "grid")
    lengths = x.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        return Whitening(0)
    model = Whitening(lengths["d"], lengths["count"])
    x = x.filter(F.size("x") == model.dimension)
    halves = x.mapInArrow(partial(sums_of, dimension=model.dimension), "at int, high long, low long")
    wide = "decimal(38,0)"
    exact = {r[0]: (int(r[1]) << 24) + int(r[2]) for r in halves.groupBy("at").agg(
        F.sum(F.col("high").cast(wide)), F.sum(F.col("low").cast(wide))).collect()}
    model.sums = [exact[i] for i in range(model.dimension)]
    scatter = _summed(x.mapInArrow(partial(scatter_of, model=model), "i int, j int, v double"), model.dimension)
    values, vectors = eigen(scatter)
    trace = np.trace(scatter)
    model.values, model.vectors = values[:components] / model.n, vectors[:, :components]
    model.explained = values[:components] / trace if trace > 0 else values[:components]
    k = len(model.values)
    if k:
        bordered = _summed(x.mapInArrow(partial(whitened_scatter_of, model=model), "i int, j int, v double"), k + 1)
        mean = bordered[:k, k] / model.n
        model.identity_error = float(np.abs(bordered[:k, :k] / model.n - np.outer(mean, mean) - np.eye(k)).max())
    return model


def transform(rows: DataFrame, model: Whitening, vector_col: str = "embedding", to: str = "whitened",
              deviation: str = "deviation") -> DataFrame:
    """The rows that the model can project, with the whitened vector and the exact deviation from the mean:
    the sum over the dimensions of (n x - S)^2."""
    @F.pandas_udf("array<double>")
    def projected(x: pd.Series) -> pd.Series:
        z = model.whitened(np.stack(x.tolist())) if len(x) else np.empty((0, 0))
        return pd.Series(list(z), dtype=object)

    small_arrow_batches(rows.sparkSession)
    x = fresh(rows, "__x")
    kept = rows.withColumn(x, grid(F.col(vector_col))).filter(F.size(x) == model.dimension)
    # A sum that no long holds leaves the deviation null.
    sums = F.array(*[F.lit(s if abs(s) < 1 << 63 else None).cast("long") for s in model.sums])
    apart = F.zip_with(x, sums, lambda a, s: F.try_subtract(F.try_multiply(a, F.lit(model.n).cast("long")), s))
    square = F.aggregate(apart, F.lit(0).cast("long"), lambda t, v: F.try_add(t, F.try_multiply(v, v)))
    return kept.withColumns({to: projected(x), deviation: square}).drop(x)
