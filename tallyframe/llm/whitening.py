"""Embedding whitening by polarisation.

No product of two dimensions is ever summed. What is summed, as exact whole
numbers, is the squared centred value of every dimension and of the sum of every
pair of dimensions. Half of the variance of a pair's sum less the variances of
the two is their covariance; the matrix put together from these goes to ``eigh``.

An entry c counts as the whole number ``floor(64 * c) + 1_000_000``. Values are
centred at the whole number below their mean, and what is left of the mean is
taken off exactly, so that no size of a mean costs digits. Tasks send one row
for every pair of dimensions, however many vectors they hold, and the driver
gets as many in all.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

SCALE, SHIFT = 64.0, 1_000_000
COMPONENTS = 32
#: Entries beyond this have no exact whole number; they count as not finite.
MOST = 2.0**52
#: Entries of a batch that are worked on at a time.
SLICE = 1 << 20
#: Exact sums travel as three numbers to this base.
_LIMB = 40

Statistic = Callable[[np.ndarray], np.ndarray]


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening of vectors with ``len(sums)`` entries.

    ``basis`` has the unit eigenvectors in columns, by falling eigenvalue, the
    largest entry of each positive. Components without variance have no whitened
    value; ``identity_error`` is over the others.
    """

    n: int
    sums: list[int]
    basis: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float

    @property
    def explained(self) -> list[float]:
        return [float(e / self.trace) if self.trace > 0 else 0.0 for e in self.eigenvalues]


def usable(rows: DataFrame, vector: str) -> Column:
    """Whether a vector is there, has entries, and all of them are finite numbers."""
    entries = F.col(f"`{vector}`").cast("array<double>")
    finite = F.forall(entries, lambda c: F.coalesce(F.abs(c) * SCALE < MOST, F.lit(False)))
    return F.coalesce(finite & (F.size(entries) > 0), F.lit(False))


def _matrices(batch: pa.RecordBatch, width: int) -> Iterator[np.ndarray]:
    """The whole numbers of the last column's vectors, some rows at a time."""
    values = batch.column(batch.num_columns - 1).flatten().to_numpy(zero_copy_only=False)
    table = values.reshape(-1, width)
    step = max(1, SLICE // width)
    for start in range(0, len(table), step):
        yield np.floor(SCALE * table[start : start + step]).astype(np.int64) + SHIFT


def _exactly(values: np.ndarray, most_squared: int) -> np.ndarray:
    """``values``, as Python's own numbers if sums of squares do not fit into 64 bits."""
    return values.astype(object) if len(values) * most_squared >= 2**62 else values


def _totals(x: np.ndarray) -> np.ndarray:
    return _exactly(x, int(np.abs(x).max(initial=0))).sum(axis=0)


def _squares(y: np.ndarray) -> np.ndarray:
    """Sums of squares of each dimension and of each pair's sum: (0, 0), (0, 1), ... (1, 1), ..."""
    most = int(np.abs(y).max(initial=0))
    y, parts = _exactly(y, 4 * most * most), []
    for i in range(y.shape[1]):
        sums = y[:, i:] + y[:, i : i + 1]
        sums[:, 0] = y[:, i]
        parts.append((sums * sums).sum(axis=0))
    return np.concatenate(parts)


def _gathered(vectors: DataFrame, width: int, of: Statistic, count: int) -> list[int]:
    """A statistic of whole numbers, summed exactly over all vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(count, object)
        for batch in batches:
            for matrix in _matrices(batch, width):
                total = total + of(matrix)
        mask = (1 << _LIMB) - 1
        columns = [
            pa.array([int(v) >> (k * _LIMB) & mask if k < 2 else int(v) >> 2 * _LIMB for v in total], pa.int64())
            for k in range(3)
        ]
        yield pa.record_batch([pa.array(range(count), pa.int32()), *columns], ["at", "a0", "a1", "a2"])

    parts = vectors.mapInArrow(run, "at int, a0 long, a1 long, a2 long")
    summed = parts.groupBy("at").agg(*[F.sum(f"a{k}").alias(f"a{k}") for k in range(3)])
    out = [0] * count
    for row in summed.collect():
        out[row["at"]] = sum(row[f"a{k}"] << (k * _LIMB) for k in range(3))
    return out


def _centred(sums: list[int], n: int) -> tuple[np.ndarray, np.ndarray]:
    """The whole centres, and what the means are above them."""
    low = [s // n for s in sums]
    rest = [(s - n * c) / n for s, c in zip(sums, low, strict=True)]
    return np.array(low, np.int64), np.array(rest)


def covariance(squares: list[int], sums: list[int], n: int) -> np.ndarray:
    """The covariance matrix from sums of squares about the whole centres; exact up to the last division."""
    width = len(sums)
    rest = [s % n for s in sums]
    first, second = np.triu_indices(width)
    # n * n times the variance of each dimension and of each pair's sum.
    spread = {}
    for i, j, q in zip(first.tolist(), second.tolist(), squares, strict=True):
        spread[i, j] = n * q - (rest[i] if i == j else rest[i] + rest[j]) ** 2
    out = np.empty((width, width))
    for (i, j), v in spread.items():
        twice = 2 * v if i == j else v - spread[i, i] - spread[j, j]
        out[i, j] = out[j, i] = twice / (2 * n * n)
    return out


def _components(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    values, vectors = np.linalg.eigh(matrix)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    # What is not above rounding is no variance.
    least = len(matrix) * np.finfo(float).eps * max(values[0], 0.0)
    return np.where(values > least, values, 0.0), vectors * sign


def _whitener(basis: np.ndarray, values: np.ndarray, low: np.ndarray, rest: np.ndarray) -> Statistic:
    scale = np.divide(1.0, np.sqrt(values), out=np.full(len(values), np.nan), where=values > 0)
    turn = basis * scale

    def run(x: np.ndarray) -> np.ndarray:
        return ((x - low) - rest) @ turn

    return run


def _identity_error(vectors: DataFrame, width: int, n: int, whiten: Statistic, held: np.ndarray) -> float:
    """The largest entry of the whitened vectors' covariance less the identity, as measured."""
    k = int(held.sum())
    if not k:
        return 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, products = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            for matrix in _matrices(batch, width):
                w = whiten(matrix)[:, held]
                sums += w.sum(axis=0)
                products += w.T @ w
        values = np.concatenate([sums, products.ravel()])
        yield pa.record_batch([pa.array(range(len(values)), pa.int32()), pa.array(values)], ["at", "v"])

    parts = vectors.mapInArrow(run, "at int, v double").groupBy("at").agg(F.sum("v").alias("v"))
    got = np.zeros(k + k * k)
    for row in parts.collect():
        got[row["at"]] = row["v"] / n
    mean, second = got[:k], got[k:].reshape(k, k)
    return float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())


def _prepared(rows: DataFrame, vector: str, *columns: Column) -> DataFrame:
    entries = F.col(f"`{vector}`").cast("array<double>")
    return rows.filter(usable(rows, vector)).select(*columns, entries.alias("vector"))


def fit(rows: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """Fit on all usable vectors of the commonest length (the longer of two); None without any."""
    lengths = _prepared(rows, vector).groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    if most is None:
        return None
    width, n = most["d"], most["n"]
    vectors = _prepared(rows, vector).filter(F.size("vector") == width)
    sums = _gathered(vectors, width, _totals, width)
    low, rest = _centred(sums, n)
    squares = _gathered(vectors, width, lambda x: _squares(x - low), width * (width + 1) // 2)
    matrix = covariance(squares, sums, n)
    values, basis = _components(matrix, components)
    error = _identity_error(vectors, width, n, _whitener(basis, values, low, rest), values > 0)
    return Whitening(n, sums, basis, values, float(np.trace(matrix)), error)


def _deviation(y: np.ndarray, rest: list[int], n: int) -> list[int | None]:
    """Sums of (n * y - rest) ** 2; None where one does not fit into 64 bits."""
    most = n * (int(np.abs(y).max(initial=0)) + 1)
    if most * most * max(y.shape[1], 1) < 2**63:
        d = n * y - np.array(rest, np.int64)
        return (d * d).sum(axis=1).tolist()
    d = n * y.astype(object) - np.array(rest, object)
    return [v if v < 2**63 else None for v in (d * d).sum(axis=1)]


def apply(rows: DataFrame, model: Whitening | None, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, deviation, whitened): one row a usable vector of the model's length; see ``whiten``."""
    shape = StructType(
        [
            StructField(key, rows.schema[key].dataType),
            StructField("deviation", LongType()),
            StructField("whitened", ArrayType(DoubleType())),
        ]
    )
    if model is None:
        return rows.sparkSession.createDataFrame([], shape)
    width, n, k = len(model.sums), model.n, len(model.eigenvalues)
    low, rest = _centred(model.sums, n)
    left = [s % n for s in model.sums]
    whitened_of = _whitener(model.basis, model.eigenvalues, low, rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for x in _matrices(batch, width):
                w = whitened_of(x)
                ends = pa.array(np.arange(len(x) + 1) * k, pa.int32())
                entries = pa.ListArray.from_arrays(ends, pa.array(w.ravel(), from_pandas=True))
                deviation = pa.array(_deviation(x - low, left, n), pa.int64())
                yield pa.record_batch(
                    [batch.column(0).slice(at, len(x)), deviation, entries], [key, "deviation", "whitened"]
                )
                at += len(x)

    vectors = _prepared(rows, vector, F.col(f"`{key}`").alias("key")).filter(F.size("vector") == width)
    return vectors.mapInArrow(run, shape)


def whiten(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS
) -> tuple[DataFrame, Whitening | None]:
    """(key, deviation, whitened) of every usable vector, and the model fitted on all of them.

    Rows go whose vector is null or empty, or holds null, infinite or undefined
    entries, or entries too large to have an exact whole number; so do vectors of
    another length than most have. Repeated vectors and keys count each, and null
    keys are kept. Without usable rows there is no model and no row. Other columns
    are not looked at. ``deviation`` is the sum over dimensions of
    ``(n * x - sum) ** 2``, null where that is no 64-bit number. Entries of
    ``whitened`` for components without variance are null.
    """
    model = fit(rows, vector, components)
    return apply(rows, model, key, vector), model


def by_component(whitened: DataFrame, model: Whitening | None) -> DataFrame:
    """One row a vector and component, with what the model knows of the component."""
    explained = model.explained if model else []
    error = model.identity_error if model else 0.0
    named = F.posexplode("whitened").alias("at", "whitened")
    flat = whitened.select(whitened.columns[0], "deviation", named)
    shares = F.array(*[F.lit(e) for e in explained]).cast("array<double>")
    return flat.select(
        flat.columns[0],
        (F.col("at") + 1).alias("component"),
        F.lit(model.n if model else 0).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
