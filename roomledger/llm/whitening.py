"""Whitening of vectors on their leading principal components.

Vectors become integers, floor(1024 c) + 100000 by entry. The leading eigenvectors of their covariance
are found by Chebyshev-filtered subspace iteration. The covariance itself is never formed: a pass over
the vectors gives X'X Q for a block Q of a few dozen columns, centred before it is multiplied. A filter
is a polynomial of the covariance, applied by its three-term recurrence with a pass for each degree; it
damps all that lies between zero and the smallest Ritz value of the block. QR and Rayleigh-Ritz follow,
and the residual of every wanted pair is measured. Sweeps go on until the residuals are at rounding
level and fall no more, then the covariance of the whitened vectors is measured against the identity.

A pass is a scan; its tasks send sums of the block's size (dimensions x columns), which Spark adds up.
The driver holds that block and nothing that grows with the rows.

Defined results: a vector that is null, empty, or holds null or non-finite entries is dropped, and so is
one whose length is not the most frequent one (the least of equally frequent ones). Entries beyond 2^30
after scaling count as 2^30. Null ids stay null; repeated rows count each. Components of no variance
(under 1e-12 of the first) do not exist, so a table of one vector, or of equal ones, or an empty one gives
no rows. A deviation beyond 38 digits is null. Vectors of any length are taken in slices of rows. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomledger.llm.common import stored
from roomledger.session import ship_package

SCALE, SHIFT = 1024, 100_000
_BOUND = 1 << 30
_SLICE = 1 << 20  # entries that are handled at a time


@dataclass(frozen=True)
class Iteration:
    """How the subspace is iterated."""

    components: int = 8
    #: Columns of the block for each component.
    guard: int = 4
    degree: int = 10
    sweeps: int = 300
    #: Residuals are to be under this part of the largest eigenvalue before they may stop falling.
    residual: float = 1e-12
    #: The covariance of whitened vectors is to be that close to the identity.
    identity: float = 1e-4
    seed: int = 12


@dataclass
class Basis:
    """The certified result: what it takes to whiten a vector."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    residual: float
    passes: int

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    @property
    def scales(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def integers(rows: DataFrame, id_: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, x) of all vectors that take part; stored."""
    entry = lambda c: c.cast("double")
    fine = F.forall(vector, lambda c: F.coalesce(F.abs(entry(c)) < float("inf"), F.lit(False)))
    scaled = F.transform(
        vector,
        lambda c: (F.least(F.greatest(F.floor(SCALE * entry(c)), F.lit(-_BOUND)), F.lit(_BOUND)) + SHIFT).cast("bigint"),
    )
    full = rows.where(F.col(vector).isNotNull() & (F.size(vector) > 0) & fine).select(F.col(id_).alias("id"), scaled.alias("x"))
    every = stored(full, "whitening-integers")
    lengths = every.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return every.where(F.size("x") == (lengths["d"] if lengths else 0))


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """Slices of a batch as (first row, matrix)."""
    if not batch.num_rows:
        return
    flat = batch.column("x").flatten().to_numpy()
    x = flat.reshape(batch.num_rows, -1)
    step = max(1, _SLICE // x.shape[1])
    for at in range(0, len(x), step):
        yield at, x[at : at + step]


def _cells(values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.arange(values.size)), pa.array(values.ravel())], names=["cell", "value"])


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The number of rows, then the sum of every dimension."""
    total = None
    for batch in batches:
        for _, x in _matrices(batch):
            own = np.r_[len(x), x.sum(0)]
            total = own if total is None else total + own
    if total is not None:
        yield _cells(total)


def _products(mean: np.ndarray, block: np.ndarray):
    """The task's part of X'XQ, and of the trace in the last cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, trace = np.zeros(block.shape), 0.0
        for batch in batches:
            for _, x in _matrices(batch):
                centred = x - mean
                total += centred.T @ (centred @ block)
                trace += float(np.einsum("ij,ij->", centred, centred))
        yield _cells(np.r_[total.ravel(), trace])

    return run


def _moments(mean: np.ndarray, scales: np.ndarray):
    """The task's sums of whitened vectors and of their products."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, k = 0.0, scales.shape[1]
        for batch in batches:
            for _, x in _matrices(batch):
                white = (x - mean) @ scales
                total = total + np.r_[white.sum(0), (white.T @ white).ravel()]
        yield _cells(total + np.zeros(k + k * k))

    return run


def _added(rows: DataFrame, task, kind: str = "double") -> dict[int, object]:
    """The sums of all tasks' cells."""
    cells = rows.select("x").mapInArrow(task, f"cell bigint, value {'double' if kind == 'double' else 'bigint'}")
    return {r["cell"]: r["s"] for r in cells.groupBy("cell").agg(F.sum(F.col("value").cast(kind)).alias("s")).collect()}


class _Covariance:
    """The covariance as an operator on blocks; every use is a pass."""

    def __init__(self, rows: DataFrame, n: int, mean: np.ndarray):
        self.rows, self.n, self.mean, self.passes, self.trace = rows, n, mean, 0, 0.0

    def __matmul__(self, block: np.ndarray) -> np.ndarray:
        found = _added(self.rows, _products(self.mean, block))
        values = np.array([found[i] for i in range(block.size + 1)]) / self.n
        self.passes, self.trace = self.passes + 1, float(values[-1])
        return values[:-1].reshape(block.shape)


def filtered(matrix, block: np.ndarray, edge: float, top: float, degree: int) -> np.ndarray:
    """A scaled Chebyshev polynomial of the matrix times the block: small on [0, edge], growing above it."""
    half = edge / 2
    sigma = half / (top - half)
    twice = 2 / sigma
    before, now = block, (matrix @ block - half * block) * (sigma / half)
    for _ in range(degree - 1):
        step = 1 / (twice - sigma)
        before, now = now, 2 * (matrix @ now - half * now) * (step / half) - sigma * step * before
        sigma = step
    return now


def leading(matrix, dimensions: int, how: Iteration) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvalues by size, their unit eigenvectors, and the largest residual against the first value.

    `matrix` is symmetric, has no negative eigenvalue and is only known by its products with blocks.
    """
    width, wanted = min(dimensions, how.components * how.guard), min(dimensions, how.components)
    if width == dimensions:
        block = np.eye(dimensions)
    else:
        block = np.linalg.qr(np.random.RandomState(how.seed).standard_normal((dimensions, width)))[0]
    last = np.inf
    for sweep in range(how.sweeps):
        image = matrix @ block
        small = block.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        block, image = block @ turn, image @ turn
        top = values[0]
        if not top > 0:
            return np.zeros(0), np.zeros((dimensions, 0)), 0.0
        rest = np.linalg.norm(image - block * values, axis=0)[:wanted].max() / top
        if rest <= how.residual and (width == dimensions or rest > last / 2):
            kept = int((values[:wanted] > 1e-12 * top).sum())
            return values[:kept], block[:, :kept], float(rest)
        last = rest
        edge = values[-1]
        if edge <= 1e-12 * top:  # the block holds all directions of variance
            block = image
        else:
            block = filtered(matrix, block, edge, top, how.degree)
        block = np.linalg.qr(block)[0]
    raise ArithmeticError(f"residual {rest} after {how.sweeps} sweeps")


def fitted(x: DataFrame, how: Iteration = Iteration()) -> Basis | None:
    """Leading components of the integers; None without rows or without variance."""
    ship_package(x.sparkSession)
    found = _added(x, _sums, "decimal(38,0)")
    if not found:
        return None
    n, sums = int(found[0]), [int(found[i]) for i in range(1, len(found))]
    matrix = _Covariance(x, n, np.array([s / n for s in sums]))
    values, vectors, rest = leading(matrix, len(sums), how)
    if not len(values):
        return None
    return Basis(n, sums, values, vectors, matrix.trace, rest, matrix.passes)


def identity_error(x: DataFrame, basis: Basis) -> float:
    """The largest entry of the whitened vectors' covariance minus the identity."""
    k = len(basis.values)
    found = _added(x, _moments(basis.mean, basis.scales))
    sums = np.array([found[i] for i in range(k)]) / basis.n
    products = np.array([found[i] for i in range(k, k + k * k)]).reshape(k, k) / basis.n
    return float(np.abs(products - np.outer(sums, sums) - np.eye(k)).max())


def _whitened(basis: Basis):
    names = ["id", "deviation", "white"]
    mean, scales, sums = basis.mean, basis.scales, np.array(basis.sums, object)
    small = basis.n * (_BOUND + SHIFT) < 1 << 60 and max(map(abs, basis.sums)) < 1 << 60

    def exact(x: np.ndarray) -> list[Decimal | None]:
        if small:  # differences fit, their squares may not
            apart = (basis.n * x - sums.astype(np.int64)).astype(object)
        else:
            apart = basis.n * x.astype(object) - sums
        return [Decimal(int(v)) if v < 10**38 else None for v in (apart * apart).sum(1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in _matrices(batch):
                white = (x - mean) @ scales
                lists = pa.ListArray.from_arrays(np.arange(0, white.size + 1, white.shape[1], dtype=np.int32), pa.array(white.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(at, len(x)), pa.array(exact(x), pa.decimal128(38, 0)), lists], names=names
                )

    return run


def whitened(rows: DataFrame, id_: str = "vec_id", vector: str = "embedding", how: Iteration = Iteration()) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error), a row per vector and component.

    deviation is the exact squared distance from the mean times n squared, as decimal(38,0).
    """
    kind = rows.schema[id_].dataType.simpleString()
    x = integers(rows, id_, vector)
    basis = fitted(x, how)
    if basis is None:
        empty = "component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
        return rows.sparkSession.createDataFrame([], f"{id_} {kind}, {empty}")
    error = identity_error(x, basis)
    if error > how.identity:
        raise ArithmeticError(f"the covariance is {error} from the identity")
    white = x.mapInArrow(_whitened(basis), f"id {kind}, deviation decimal(38,0), white array<double>")
    explained = F.array(*[F.lit(float(v / basis.trace)) for v in basis.values])
    return white.select("id", "deviation", F.posexplode("white").alias("at", "whitened")).select(
        F.col("id").alias(id_), (F.col("at") + 1).cast("int").alias("component"), F.lit(basis.n).cast("bigint").alias("n"),
        "deviation", "whitened", F.get(explained, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
    )
