"""Embedding whitening by pivoted Cholesky of the centred scatter and one-sided Jacobi.

Entries become whole numbers, so that sums over all rows are exact in any order. The rows are
centred on the whole number nearest to the mean of their dimension before they are multiplied; what
is left, less than one half a dimension, is taken off the scatter exactly. The scatter is factored
with pivoting into a triangular factor; rotations of its columns make them orthogonal. Their squared
norms are the eigenvalues and the columns, normalised, the components.

Tasks hand over sums of one number per pair of dimensions, the driver holds one such matrix; both
are bounded by the dimension and do not grow with the rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replenish.llm.common import col, prepare_python
from replenish.operators.scale import materialise

SCALE = 1024
OFFSET = 100_000
COMPONENTS = 8
# Scaled entries beyond this have no long; signed digits of so many bits multiply exactly as doubles.
LARGEST = 2.0**61
DIGIT = 20

_SWEEPS = 60


# --- the vectors of a batch -------------------------------------------------------------------


def clean(batch: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a batch that remain, and floor(SCALE * entry) of their entries, as longs."""
    lengths = np.array(batch.value_lengths().fill_null(-1), dtype=np.int64)
    rows = np.flatnonzero(lengths == width)
    # Null entries become NaN and fall with the other entries that are not finite.
    flat = batch.take(pa.array(rows)).flatten().cast(pa.float64())
    values = flat.to_numpy(zero_copy_only=False).reshape(len(rows), width)
    with np.errstate(invalid="ignore", over="ignore"):
        scaled = np.floor(values * SCALE)
        whole = (np.abs(scaled) < LARGEST).all(axis=1)
    return rows[whole], scaled[whole].astype(np.int64)


def digits(values: np.ndarray) -> list[np.ndarray]:
    """Signed digits of whole numbers to the base 2**DIGIT, the lowest first, as doubles."""
    out, half = [], 1 << (DIGIT - 1)
    while True:
        low = ((values + half) & ((1 << DIGIT) - 1)) - half
        out.append(low.astype(np.float64))
        values = (values - low) >> DIGIT
        if not values.any():
            return out


def exact_product(values: np.ndarray) -> np.ndarray:
    """values^T values without rounding, as Python integers. At most 2**13 rows."""
    parts = digits(values)
    total = np.zeros((values.shape[1],) * 2, dtype=object)
    for i, left in enumerate(parts):
        for j, right in enumerate(parts):
            # Below 2**(2 * DIGIT - 2 + 13) = 2**51.
            total += (left.T @ right).astype(np.int64).astype(object) << DIGIT * (i + j)
    return total


# --- the factor and its rotation --------------------------------------------------------------


def pivoted_cholesky(scatter: np.ndarray) -> np.ndarray:
    """Columns L with L L^T = scatter, one per step; the rows of step k are zero at the pivots
    before it, so that L is triangular in the order of the pivots. Ends at the numeric rank."""
    left, n = scatter.copy(), len(scatter)
    diagonal = left.diagonal().copy()
    limit = diagonal.max(initial=0.0) * n * np.finfo(float).eps
    columns, free = [], np.ones(n, dtype=bool)
    for _ in range(n):
        pivot = int(np.argmax(np.where(free, diagonal, -1.0)))
        if not diagonal[pivot] > limit:
            break
        column = left[:, pivot] / np.sqrt(diagonal[pivot])
        column[~free] = 0.0
        columns.append(column)
        left -= np.outer(column, column)
        diagonal = left.diagonal().copy()
        free[pivot] = False
    return np.array(columns).T.reshape(n, len(columns))


def jacobi_columns(factor: np.ndarray) -> np.ndarray:
    """The columns of a factor, rotated until all are orthogonal, by falling norm. Every round of
    a sweep rotates disjoint pairs of columns at once."""
    own = factor.copy()
    size = own.shape[1]
    places = np.arange(size + size % 2)  # an odd column out meets a place that has none
    for _ in range(_SWEEPS):
        turned = False
        for _ in range(len(places) - 1):
            p, q = places[: len(places) // 2], places[::-1][: len(places) // 2]
            real = (p < size) & (q < size)
            p, q = p[real], q[real]
            turned |= _rotate(own, p, q)
            places = np.concatenate([places[:1], places[-1:], places[1:-1]])
        if not turned:
            break
    norms = (own * own).sum(axis=0)
    return own[:, np.argsort(-norms, kind="stable")]


def _rotate(own: np.ndarray, p: np.ndarray, q: np.ndarray) -> bool:
    one, other = own[:, p], own[:, q]
    a, b, c = (one * one).sum(axis=0), (other * other).sum(axis=0), (one * other).sum(axis=0)
    wrong = np.abs(c) > np.finfo(float).eps * np.sqrt(a * b)
    if not wrong.any():
        return False
    one, other, p, q = one[:, wrong], other[:, wrong], p[wrong], q[wrong]
    zeta = (b[wrong] - a[wrong]) / (2 * c[wrong])
    tangent = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
    cosine = 1 / np.hypot(1.0, tangent)
    own[:, p], own[:, q] = cosine * (one - tangent * other), cosine * (other + tangent * one)
    return True


# --- sums over all rows -----------------------------------------------------------------------


@dataclass(frozen=True)
class Moments:
    """Exact sums over the rows that remain, of x less OFFSET."""

    n: int
    sums: tuple[int, ...]

    @property
    def centre(self) -> np.ndarray:
        """The whole number nearest to the mean of each dimension."""
        return np.array([round(Fraction(s, self.n)) for s in self.sums], dtype=np.int64)

    @property
    def rest(self) -> list[int]:
        """n times the mean of what is centred."""
        return [s - self.n * int(c) for s, c in zip(self.sums, self.centre)]


@dataclass(frozen=True)
class Components:
    """Moments, components as rows (unit vectors by falling eigenvalue), eigenvalues, trace."""

    moments: Moments
    vectors: np.ndarray
    eigenvalues: np.ndarray
    trace: float


def width_of(vectors: DataFrame, embedding: str) -> int:
    """The most common length of vectors that are not null; of equals the greatest."""
    sizes = vectors.filter(col(embedding).isNotNull()).groupBy(F.size(col(embedding)).alias("n")).count()
    best = sizes.agg(F.max_by("n", F.struct("count", "n")).alias("n")).first()["n"]
    return best or 0


_SUMS = "i int, j int, value decimal(38,0)"


def _summed(vectors: DataFrame, embedding: str, per_task) -> DataFrame:
    """Runs `per_task` (batches -> rows i, j, value) and adds the values up."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = per_task(batch.column(0) for batch in batches)
        i, j, value = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(i, pa.int32()),
                pa.array(j, pa.int32()),
                pa.array(list(map(Decimal, map(int, value))), pa.decimal128(38, 0)),
            ],
            ["i", "j", "value"],
        )

    found = vectors.select(col(embedding)).mapInArrow(run, _SUMS)
    return found.groupBy("i", "j").agg(F.sum("value").alias("value"))


def moments(vectors: DataFrame, embedding: str, width: int) -> Moments:
    def per_task(batches: Iterator[pa.Array]) -> list[tuple[int, int, int]]:
        n, sums = 0, np.zeros(width, dtype=object)
        for batch in batches:
            _, x = clean(batch, width)
            n += len(x)
            for k, part in enumerate(digits(x)):
                sums += part.sum(axis=0).astype(np.int64).astype(object) << DIGIT * k
        return [(-1, -1, n), *((d, d, s) for d, s in enumerate(sums))]

    found = {r["i"]: int(r["value"]) for r in _summed(vectors, embedding, per_task).collect()}
    return Moments(found.get(-1, 0), tuple(found.get(d, 0) for d in range(width)))


def fit(vectors: DataFrame, embedding: str = "embedding", components: int = COMPONENTS) -> Components:
    """The components of all vectors that remain (see `whitened`)."""
    prepare_python(vectors.sparkSession)
    width = width_of(vectors, embedding)
    own = moments(vectors, embedding, width)
    if not own.n or not width:
        return Components(own, np.zeros((0, width)), np.zeros(0), 0.0)
    centre = own.centre

    def per_task(batches: Iterator[pa.Array]) -> list[tuple[int, int, int]]:
        total = np.zeros((width, width), dtype=object)
        for batch in batches:
            _, x = clean(batch, width)
            total += exact_product(x - centre)
        return [(i, j, total[i, j]) for i in range(width) for j in range(i, width)]

    scatter, rest, n = np.zeros((width, width)), own.rest, own.n
    for row in _summed(vectors, embedding, per_task).collect():
        i, j = row["i"], row["j"]
        scatter[i, j] = scatter[j, i] = float(Fraction(int(row["value"]) * n - rest[i] * rest[j], n))
    rotated = jacobi_columns(pivoted_cholesky(scatter))
    norms = np.sqrt((rotated * rotated).sum(axis=0))
    kept = slice(0, min(components, len(norms)))
    return Components(
        own, (rotated / norms).T[kept], (norms * norms / n)[kept], float(scatter.trace() / n)
    )


def _deviations(x: np.ndarray, sums: list[int], n: int) -> list[int | None]:
    """Sum over dimensions of (n * x - sum)^2, exact; None where it does not fit a long."""
    most = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0)
    kind = np.int64 if most * most * max(x.shape[1], 1) < 1 << 63 else object
    scaled = x.astype(kind) * n - np.array(sums, dtype=kind)
    return [v if v < 1 << 63 else None for v in map(int, (scaled * scaled).sum(axis=1))]


def projected(
    vectors: DataFrame, model: Components, key: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """vec_id, deviation and the whitened values (array<double>) of every row that remains."""
    prepare_python(vectors.sparkSession)
    own, width = model.moments, model.vectors.shape[1]
    n = max(own.n, 1)
    centre, rest = own.centre if own.n else np.zeros(width, np.int64), own.rest if own.n else []
    turn = (model.vectors / np.sqrt(model.eigenvalues)[:, None]).T
    mean = np.array([r / n for r in rest])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, x = clean(batch.column(1), width)
            near = x - centre
            values = (near - mean) @ turn
            offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * values.shape[1])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows)),
                    pa.array(_deviations(near, rest, n), pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(values.ravel())),
                ],
                ["vec_id", "deviation", "whitened"],
            )

    narrow = vectors.select(col(key).cast("bigint").alias("vec_id"), col(embedding))
    return narrow.mapInArrow(run, "vec_id bigint, deviation bigint, whitened array<double>")


def identity_error(projections: DataFrame, size: int) -> float:
    """The largest entry, without sign, of the covariance of the whitened values less the identity.

    The values are centred on their means before they are multiplied."""
    if not size:
        return 0.0
    value = [F.col("whitened")[k] for k in range(size)]
    means = projections.agg(*[F.avg(v) for v in value]).first()
    if means[0] is None:
        return 0.0
    apart = [v - F.lit(m) for v, m in zip(value, means)]
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    found = projections.agg(*[F.avg(apart[i] * apart[j]) for i, j in pairs]).first()
    return max(abs(v - (i == j)) for v, (i, j) in zip(found, pairs))


def whitened(
    vectors: DataFrame,
    key: str = "vec_id",
    embedding: str = "embedding",
    components: int = COMPONENTS,
) -> DataFrame:
    """One row per vector that remains and component: vec_id, component, n, deviation, whitened,
    explained, identity_error.

    A vector remains if it is not null, has the most common length of all, and every entry is
    finite and, scaled, within a long. Keys may repeat or be null: every row counts. Directions
    without variance have no component, so a table of equal vectors, of one row, of empty vectors or
    without rows gives none. A deviation beyond a long is null. Other columns are not read.
    """
    model = fit(vectors, embedding, components)
    size = len(model.eigenvalues)
    table = materialise(projected(vectors, model, key, embedding))
    error = identity_error(table, size)
    shares = F.array(*[F.lit(float(e) / model.trace) for e in model.eigenvalues]).cast("array<double>")
    return table.select("vec_id", "deviation", F.posexplode("whitened")).select(
        "vec_id",
        (F.col("pos") + 1).cast("int").alias("component"),
        F.lit(model.moments.n).cast("bigint").alias("n"),
        "deviation",
        F.col("col").alias("whitened"),
        F.get(shares, F.col("pos")).alias("explained"),
        F.lit(float(error)).alias("identity_error"),
    )
