"""The optimum of multinomial logistic regression, found in passes over compact blocks of rows.

The rows are converted once, to blocks that hold each column in the narrowest type
that holds its values exactly. These are kept, and every step of the search is one pass
over them that sends one partial loss and gradient a task. The search is L-BFGS in a
basis of the features in which their second moments are the unit matrix, where it takes
about half the steps; the weights are those of the features as they are.
"""

from __future__ import annotations

import sys
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The workers need not have this package: what they run is sent to them whole.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Narrower types that a column of a block is tried in.
_NARROW = ("i1", "i2", "f4")

_BLOCK = "n int, kinds string, values binary"

# Wider rows are only scaled, since the moments grow with the square of the width.
_MOST_MOMENTS = 1024

# Rows that are worked on at a time within a block.
_CHUNK = 2048

# Corrections that L-BFGS remembers, and steps over which the loss must have settled.
_MEMORY, _SETTLED = 10, 20


@dataclass
class Optimum:
    """Weights (classes x features) and the mean loss after each step, from weights of zero on."""

    weights: np.ndarray
    losses: list[float] = field(default_factory=list)


def _packed(column: np.ndarray) -> tuple[str, bytes]:
    for kind in _NARROW:
        with np.errstate(all="ignore"):
            narrow = column.astype(kind)
            if np.array_equal(narrow.astype("f8"), column):
                return kind, narrow.tobytes()
    return "f8", column.tobytes()


def _pack(num_classes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            labels, x = batch.column(0), batch.column(1)
            if labels.null_count or x.null_count:
                raise ValueError("a label or a vector of features is null")
            labels = labels.to_numpy(zero_copy_only=False)
            if not ((labels >= 0) & (labels < num_classes) & (labels == np.floor(labels))).all():
                raise ValueError(f"a label is none of the classes 0 to {num_classes - 1}")
            sizes = np.diff(x.offsets.to_numpy())
            if (sizes != sizes[0]).any():
                raise ValueError("vectors of features of different sizes")
            rows = x.flatten().to_numpy(zero_copy_only=False).reshape(n, sizes[0])
            if not np.isfinite(rows).all():
                raise ValueError("a feature is not a number or not finite")
            packed = [_packed(labels), *[_packed(np.ascontiguousarray(c)) for c in rows.T]]
            kinds, values = ",".join(kind for kind, _ in packed), b"".join(part for _, part in packed)
            yield pa.RecordBatch.from_arrays(
                [pa.array([n], pa.int32()), pa.array([kinds]), pa.array([values], pa.binary())],
                ["n", "kinds", "values"],
            )

    return pack


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(labels, features x rows) of each block."""
    for batch in batches:
        for n, kinds, values in zip(*(batch.column(i) for i in range(3)), strict=True):
            n, kinds, data, at = n.as_py(), kinds.as_py().split(","), values.as_buffer(), 0
            columns = []
            for kind in kinds:
                columns.append(np.frombuffer(data, kind, n, at))
                at += n * columns[-1].itemsize
            x = np.empty((len(kinds) - 1, n))
            for row, column in zip(x, columns[1:], strict=True):
                row[:] = column
            yield columns[0].astype(np.intp), x


def _moments_of(x: np.ndarray) -> np.ndarray:
    return x @ x.T if len(x) <= _MOST_MOMENTS else (x * x).sum(axis=1)


def _measure(num_classes: int):
    def measure(blocks):
        total, low, high, moments, sums = 0, None, None, 0.0, 0.0
        for labels, x in blocks:
            if low is not None and len(low) != len(x):
                raise ValueError("vectors of features of different sizes")
            total += len(labels)
            low = x.min(axis=1) if low is None else np.minimum(low, x.min(axis=1))
            high = x.max(axis=1) if high is None else np.maximum(high, x.max(axis=1))
            moments = moments + _moments_of(x)
            # Sums of the features by class: (classes x features).
            sums = sums + np.array([np.bincount(labels, row, num_classes) for row in x]).T
        if total:
            yield total, low, high, moments, sums

    return measure


def _descend(weights: np.ndarray):
    """What all classes together add to the loss and the gradient; what the labels add is known."""

    def descend(blocks):
        loss, gradient, total = 0.0, np.zeros_like(weights), 0
        # Few rows at a time, in the same memory, which stays near the processor.
        held = np.empty((len(weights), _CHUNK))
        for labels, x in blocks:
            for at in range(0, len(labels), _CHUNK):
                part = x[:, at : at + _CHUNK]
                z = held[:, : part.shape[1]]
                np.matmul(weights, part, out=z)
                most = z.max(axis=0)
                z -= most
                np.exp(z, out=z)
                each = z.sum(axis=0)
                loss += most.sum() + np.log(each).sum()
                z *= 1 / each
                gradient += z @ part.T
            total += len(labels)
        if total:
            yield total, np.array([loss]), gradient

    return descend


def _passed(blocks: DataFrame, work: Callable) -> list[tuple]:
    """What ``work`` yields on each task's blocks: a count, then arrays of numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for count, *arrays in work(_unpacked(batches)):
            parts = pa.array([[a.ravel().tobytes() for a in arrays]], pa.list_(pa.binary()))
            yield pa.RecordBatch.from_arrays([pa.array([count], pa.int64()), parts], ["n", "parts"])

    found = blocks.mapInArrow(run, "n long, parts array<binary>").collect()
    return [(row["n"], *(np.frombuffer(bytes(p)) for p in row["parts"])) for row in found]


def _basis(low: np.ndarray, high: np.ndarray, moments: np.ndarray) -> np.ndarray:
    """Directions (features x fewer) of second moment 1. A feature of one value has no part in them."""
    varied = np.flatnonzero(low < high)
    if moments.ndim == 1:
        basis = np.zeros((len(low), len(varied)))
        basis[varied, np.arange(len(varied))] = 1 / np.sqrt(moments[varied])
        return basis
    size = np.sqrt(np.diag(moments)[varied])
    values, vectors = np.linalg.eigh(moments[np.ix_(varied, varied)] / np.outer(size, size))
    held = values > 1e-12 * max(values, default=0.0)
    basis = np.zeros((len(low), held.sum()))
    basis[varied] = vectors[:, held] / np.sqrt(values[held]) / size[:, None]
    return basis


def _direction(gradient: np.ndarray, scale: float, steps: deque) -> np.ndarray:
    """Where L-BFGS goes, from pairs of (step, change of the gradient)."""
    to, shares = gradient.copy(), []
    for step, change in reversed(steps):
        share = (step @ to) / (step @ change)
        shares.append(share)
        to -= share * change
    if steps:
        step, change = steps[-1]
        scale = (step @ change) / (change @ change)
    to *= scale
    for (step, change), share in zip(steps, reversed(shares), strict=True):
        to += (share - (change @ to) / (step @ change)) * step
    return -to


def _search(
    loss_at: Callable[[np.ndarray], tuple[float, np.ndarray]],
    start: np.ndarray,
    scale: float,
    iterations: int,
    tolerance: float,
) -> tuple[np.ndarray, list[float]]:
    """L-BFGS with halved steps. It ends as the estimator's does.

    That is when the loss has changed by no more than ``tolerance`` of the first one
    in twenty steps, or the gradient is that small against the loss.
    """
    at, (loss, gradient) = start, loss_at(start)
    losses, steps = [loss], deque(maxlen=_MEMORY)
    while len(losses) <= iterations and np.linalg.norm(gradient) > max(tolerance * abs(loss), 1e-8):
        to = _direction(gradient, scale, steps)
        slope, length = gradient @ to, 1.0
        for _ in range(30):
            there = at + length * to
            loss_there, gradient_there = loss_at(there)
            if loss_there <= loss + 1e-4 * length * slope:
                break
            length /= 2
        else:
            break  # no step is downhill: as near as numbers of 64 bits get
        step, change = there - at, gradient_there - gradient
        if step @ change > 1e-14 * (change @ change):
            steps.append((step, change))
        at, loss, gradient = there, loss_there, gradient_there
        losses.append(loss)
        if max(losses[-_SETTLED:]) - loss <= tolerance * losses[0]:
            break
    return at, losses


def optimum(examples: DataFrame, num_classes: int, iterations: int, tolerance: float) -> Optimum:
    """Weights without intercept that the labels 0 .. num_classes-1 are likeliest under, over all rows.

    A label that is none of the classes fails the job, a feature that is not finite too.
    A feature that has one value only keeps weights of zero, as in Spark's estimator.
    """
    rows = examples.select(
        F.col("label").cast("double").alias("label"), vector_to_array("features").alias("x")
    )
    blocks = rows.mapInArrow(_pack(num_classes), _BLOCK).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        measured = _passed(blocks, _measure(num_classes))
        if not measured:
            raise ValueError("no examples to fit")
        counts, lows, highs, moments, sums = zip(*measured, strict=True)
        if len({len(low) for low in lows}) > 1:
            raise ValueError("vectors of features of different sizes")
        total, width = sum(counts), len(lows[0])
        shape = (width, width) if width <= _MOST_MOMENTS else (width,)
        basis = _basis(
            np.min(lows, axis=0), np.max(highs, axis=0), (sum(moments) / total).reshape(shape)
        )
        labelled = sum(sums).reshape(num_classes, width)

        def loss_at(flat: np.ndarray) -> tuple[float, np.ndarray]:
            weights = flat.reshape(num_classes, -1) @ basis.T
            parts = _passed(blocks, _descend(weights))
            loss = sum(part[1][0] for part in parts) - (weights * labelled).sum()
            gradient = sum(part[2] for part in parts).reshape(num_classes, width) - labelled
            return float(loss) / total, (gradient @ basis).ravel() / total

        start = np.zeros(num_classes * basis.shape[1])
        # At weights of zero, the second derivative in this basis is 1 / num_classes.
        found, losses = _search(loss_at, start, num_classes, iterations, tolerance)
    finally:
        blocks.unpersist()
    weights = found.reshape(num_classes, -1) @ basis.T
    # The same number added to a feature's weights in every class changes nothing.
    return Optimum(weights - weights.mean(axis=0), losses)
