"""Operator 13: whitening of embeddings by Chebyshev-filtered subspace iteration.

Entries become whole numbers x = floor(scale * c) + offset. The covariance matrix V is never formed: a pass over the
data returns V Q for a thin block Q, from centred rows, summed per task, then per group of tasks. A short Lanczos run
bounds the spectrum from below. Each round damps what lies between that bound and the smallest Ritz value of the block
with a Chebyshev polynomial of V (one pass per degree), takes a QR factorisation and the Ritz pairs of the block, and
looks at the residuals |V q - e q| of the wanted components; they certify the result. Where the residuals fall slowly
the block grows, at last to the whole space, so that every spectrum ends certified.

The vectors are written once as packed blocks of rows; passes read those. The driver holds the block (dimensions x
block size), never rows.

Defined results: rows whose vector is NULL, holds NULL or a non-finite entry, or has another length than most vectors
(of equally frequent lengths the longest) are dropped; entries beyond 2^40 in size count as 2^40; components whose
eigenvalue is zero (fewer different vectors than components) are left out, so tables without rows or with one vector
only give no rows; a deviation beyond a long is NULL; equal rows and NULL ids are rows as any other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillspan.llm.common import Scratch

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
# Columns of the block for each wanted component, and the degree of a filter.
OVERSAMPLING = 4
DEGREE = 8
LANCZOS_STEPS = 10
# Residuals, as a share of the largest eigenvalue, that certify the components.
TOLERANCE = 1e-13
MAX_ROUNDS = 100
# A round that shrinks the residual less than this makes the block grow.
SLOW = 0.2
LARGEST = float(1 << 40)
ROWS_PER_BLOCK = 4096
# Eigenvalues below this share of the largest are zero.
NOTHING = 1e-12

Partial = Callable[[np.ndarray], np.ndarray]


@dataclass(frozen=True)
class Basis:
    """Eigenvectors (columns), eigenvalues and the trace of the covariance; sums of all dimensions; how it was found."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    residual: float
    passes: int

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def _whole(vectors: pa.Array, dims: int) -> np.ndarray:
    """Rows of whole numbers from a column of lists of one length without NULLs."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
    return np.floor(np.clip(flat, -LARGEST, LARGEST) * SCALE).astype(np.int64) + OFFSET


def usable(df: DataFrame, vector: str = "embedding") -> tuple[DataFrame, int]:
    """Rows with finite vectors of the most frequent length, and that length (0 where there is none)."""
    finite = F.forall(F.col(vector), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    rows = df.where(F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False)) & (F.size(vector) > 0))
    lengths = rows.groupBy(F.size(vector).alias("dims")).agg(F.count(F.lit(1)).alias("n"))
    first = lengths.orderBy(F.desc("n"), F.desc("dims")).limit(1).collect()
    dims = first[0]["dims"] if first else 0
    return rows.where(F.size(vector) == dims), dims


def _packed(rows: DataFrame, vector: str, dims: int) -> DataFrame:
    """Blocks of rows as bytes of 64-bit numbers."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _whole(batch.column(0), dims)
            parts = [x[k : k + ROWS_PER_BLOCK].tobytes() for k in range(0, len(x), ROWS_PER_BLOCK)]
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.binary())], ["block"])

    return rows.select(vector).mapInArrow(work, "block binary")


class Passes:
    """Sums over all rows of packed blocks."""

    def __init__(self, blocks: DataFrame, dims: int):
        self.blocks, self.dims, self.made = blocks, dims, 0
        # The sums of so many tasks are added in one task, so that the driver adds the square root of their number.
        self.groups = max(1, round(blocks.rdd.getNumPartitions() ** 0.5))

    def total(self, partial: Partial, shape: tuple[int, ...], dtype: type = np.float64) -> np.ndarray:
        """The sum of `partial(x)` over blocks of rows x, an array of `shape`."""
        dims, name = self.dims, np.dtype(dtype).str
        self.made += 1

        def summed(arrays: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
            out = np.zeros(shape, name)
            for array in arrays:
                out += array
            yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], ["part"])

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts = (part for batch in batches for part in batch.column(0))
            yield from summed(partial(np.frombuffer(p.as_buffer(), np.int64).reshape(-1, dims)) for p in parts)

        def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = (part for batch in batches for part in batch.column(0))
            yield from summed(np.frombuffer(p.as_buffer(), name).reshape(shape) for p in found)

        each = self.blocks.mapInArrow(rows, "part binary").repartition(self.groups).mapInArrow(parts, "part binary")
        return sum((np.frombuffer(row["part"], name).reshape(shape) for row in each.collect()), np.zeros(shape, name))

    def covariance_times(self, q: np.ndarray, mean: np.ndarray, n: int) -> np.ndarray:
        def partial(x: np.ndarray) -> np.ndarray:
            centred = x - mean
            return centred.T @ (centred @ q)

        return self.total(partial, q.shape) / n


def _below(times: Callable[[np.ndarray], np.ndarray], dims: int, rng: np.random.Generator) -> float:
    """A bound near the smallest eigenvalue, by a few Lanczos steps with full orthogonalisation."""
    q = [rng.standard_normal(dims)]
    q[0] /= np.linalg.norm(q[0])
    alpha, beta = [], []
    for _ in range(min(LANCZOS_STEPS, dims)):
        w = times(q[-1][:, None])[:, 0]
        alpha.append(q[-1] @ w)
        basis = np.array(q)
        w -= basis.T @ (basis @ w)
        w -= basis.T @ (basis @ w)
        beta.append(np.linalg.norm(w))
        if beta[-1] <= NOTHING * max(map(abs, alpha)):
            break
        q.append(w / beta[-1])
    t = np.diag(alpha) + np.diag(beta[: len(alpha) - 1], 1) + np.diag(beta[: len(alpha) - 1], -1)
    values, vectors = np.linalg.eigh(t)
    return max(0.0, values[0] - abs(beta[-1] * vectors[-1, 0]))


def _filtered(times: Callable[[np.ndarray], np.ndarray], q: np.ndarray, low: float, high: float, top: float) -> np.ndarray:
    """The Chebyshev polynomial of V that stays small on [low, high], times q, scaled to stay near 1 at `top`."""
    half, centre = (high - low) / 2, (high + low) / 2
    first = half / (top - centre)
    sigma, before = first, q
    now = (times(q) - centre * q) * (sigma / half)
    for _ in range(DEGREE - 1):
        after = 1 / (2 / first - sigma)
        before, now = now, (times(now) - centre * now) * (2 * after / half) - before * (sigma * after)
        sigma = after
    return now


def eigenbasis(rows: DataFrame, vector: str, dims: int, components: int = COMPONENTS) -> tuple[Basis | None, Passes]:
    """The leading eigenvectors of the covariance of all rows; None without rows or without any spread."""
    spark = rows.sparkSession
    passes = Passes(Scratch(spark, "whitening").save(_packed(rows, vector, max(dims, 1))), max(dims, 1))
    # Sums of 32-bit halves can't overflow before 2^31 rows a task; the driver puts them together exactly.
    halves = passes.total(lambda x: np.array([(x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0), np.full(x.shape[1], len(x))]), (3, passes.dims), np.int64)
    n = int(halves[2][0])
    if not n:
        return None, passes
    sums = [(int(a) << 32) + int(b) for a, b in zip(halves[0], halves[1], strict=True)]
    mean = np.array([s / n for s in sums])
    trace = float(passes.total(lambda x: np.array([((x - mean) ** 2).sum()]), (1,))[0]) / n
    if not trace:
        return None, passes
    rng = np.random.default_rng(13)
    times = lambda q: passes.covariance_times(q, mean, n)
    wanted = min(components, dims)
    size = min(dims, OVERSAMPLING * wanted)
    low = _below(times, dims, rng) if size < dims else 0.0
    q, before = np.linalg.qr(rng.standard_normal((dims, size)))[0], np.inf
    for _ in range(MAX_ROUNDS):
        v = times(q)
        values, turn = np.linalg.eigh((q.T @ v + v.T @ q) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, v = q @ turn, v @ turn
        residual = float(np.linalg.norm(v[:, :wanted] - q[:, :wanted] * values[:wanted], axis=0).max() / values[0])
        if residual <= TOLERANCE:
            break
        if residual > SLOW * before and size < dims:
            size = min(dims, 2 * size)
            q = np.linalg.qr(np.hstack([q, rng.standard_normal((dims, size - q.shape[1]))]))[0]
            before = np.inf
            continue
        if size == dims and before < np.inf and residual > SLOW * before:
            break  # nothing outside the block is left: what remains is rounding
        before = residual
        high = values[-1]
        if size < dims and low < high < values[0]:
            q = _filtered(times, q, low, high, values[0])
        q = np.linalg.qr(q)[0]
    if residual > 100 * TOLERANCE:
        raise RuntimeError(f"components not certified: residual {residual:.1e} of the largest eigenvalue")
    kept = int((values[:wanted] > NOTHING * values[0]).sum())
    return Basis(n, sums, q[:, :kept].copy(), values[:kept].copy(), trace, residual, passes.made), passes


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sums of (n x - S)^2; Python's whole numbers where 64 bits could overflow."""
    exact = np.array(sums, dtype=object)
    largest = max(abs(n * int(x.max()) - min(sums)), abs(n * int(x.min()) - max(sums)))
    if largest**2 * x.shape[1] < 1 << 63:
        apart = x * n - exact.astype(np.int64)
        return (apart * apart).sum(1).tolist()
    apart = x.astype(object) * n - exact
    return [d if d < 1 << 63 else None for d in (apart * apart).sum(1)]


def whiten(df: DataFrame, components: int = COMPONENTS, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) of each usable row and component."""
    rows, dims = usable(df.select(id, vector), vector)
    basis, passes = eigenbasis(rows, vector, dims, components)
    kind = df.schema[id].dataType.simpleString()
    schema = f"`{id}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if basis is None or not basis.values.size:
        return df.sparkSession.createDataFrame([], schema)
    mean, k = basis.mean, basis.values.size
    weights = basis.vectors / np.sqrt(basis.values)

    def moments(x: np.ndarray) -> np.ndarray:
        z = (x - mean) @ weights
        return np.vstack([z.T @ z, z.sum(0)])

    found = passes.total(moments, (k + 1, k)) / basis.n
    error = float(np.abs(found[:k] - np.outer(found[k], found[k]) - np.eye(k)).max())
    explained = basis.values / basis.trace
    n, sums = basis.n, basis.sums

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _whole(batch.column(1), dims)
            each = np.repeat(np.arange(len(x)), k)
            columns = [
                batch.column(0).take(pa.array(each)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(each), n, np.int64)),
                pa.array(_deviations(x, n, sums), pa.int64()).take(pa.array(each)),
                pa.array(((x - mean) @ weights).reshape(-1)),
                pa.array(np.tile(explained, len(x))),
                pa.array(np.full(len(each), error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, [id, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(work, schema)


def basis_of(spark: SparkSession, df: DataFrame, components: int = COMPONENTS, vector: str = "embedding") -> Basis | None:
    """The certified basis alone, for projecting other tables."""
    rows, dims = usable(df, vector)
    return eigenbasis(rows, vector, dims, components)[0]
