"""Quality classifier: random-indexing word vectors, pooled, and a small calibrated network.

Random indexing gives every word a sparse random vector of few entries +1 and -1,
and sums up, for each word, the vectors of the words beside it, over the whole
corpus. Words share ``2 ** WORD_BITS`` places by their hash, so that the sums are
one table of fixed size whatever the vocabulary; tasks add up theirs before
they are shuffled. The unit vectors of a document's words are pooled to their
mean and spread, weighted so that words that fill the corpus count less.

Pooled vectors of labelled documents train a network of two layers in numpy, and
a temperature fitted on a part of them that it was not trained on turns its
outputs into probabilities. At most ``fit_rows`` labelled documents are used;
that is the bound of the sample. Nothing but the text enters a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import whole_text
from tallyframe.llm.shingles import mixed

WORD_BITS = 14
WIDTH = 64
#: Entries of a word's random vector that are not zero.
ENTRIES = 4
#: Words on each side that are beside a word.
REACH = 2
#: Words are cut at multiples of so many bytes of a text, and none there is beside another.
PIECE_BYTES = 1 << 16
#: Bytes worked on at a time; what is made of them holds some hundred numbers a word.
STRETCH = 1 << 18
#: A word's weight is this over itself and the word's share of the corpus.
RARE = 1e-3

FIT_ROWS = 20_000
HELD_OUT, FOLDS, CALIBRATION = 0, 5, 1
THRESHOLD = 0.3
HIDDEN = 32
EPOCHS, BATCH, RATE, DECAY = 40, 256, 3e-3, 1e-4
SEED = 20_240_101

_BASE = 0x9E3779B97F4A7C15
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_DIGIT = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


# ---- words ----


class _Powers:
    """Powers of an odd number and of its inverse modulo 2**64, made once in a worker."""

    _made: tuple[np.ndarray, np.ndarray] | None = None

    @classmethod
    def of(cls, count: int) -> tuple[np.ndarray, np.ndarray]:
        if cls._made is None or len(cls._made[0]) < count:
            made = []
            for base in (_BASE, pow(_BASE, -1, 2**64)):
                row = np.full(max(count, STRETCH + 1), base, np.uint64)
                row[0] = 1
                made.append(np.multiply.accumulate(row))
            cls._made = tuple(made)
        return cls._made[0][:count], cls._made[1][:count]


def _pieces(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, start and end of each piece of texts of these lengths, laid end to end."""
    starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    times = -(-lengths // PIECE_BYTES)
    text = np.repeat(np.arange(len(lengths)), times)
    first = np.repeat(np.cumsum(times) - times, times)
    start = starts[text] + (np.arange(len(text)) - first) * PIECE_BYTES
    return text, start, np.minimum(start + PIECE_BYTES, starts[text] + lengths[text])


def places(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of each word's hash, and the piece it lies in, for pieces that lie end to end."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = ~_BLANK[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[start] = edge[end] = True
    first = np.flatnonzero(word & (edge[:-1] | np.concatenate([[True], ~word[:-1]])))
    last = np.flatnonzero(word & (edge[1:] | np.concatenate([~word[1:], [True]]))) + 1
    up, down = _Powers.of(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_DIGIT[data] * up[:-1], out=sums[1:])
    hashes = mixed((sums[last] - sums[first]) * down[first])
    return (hashes >> np.uint64(64 - WORD_BITS)).astype(np.int64), np.searchsorted(end, first, "right")


def _stretches(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place of each word, its text) of a column of texts, some pieces at a time.

    A text that is null counts as empty.
    """
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    if data is None:
        return
    ends = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]
    text, start, end = _pieces(np.diff(ends))
    at = 0
    while at < len(text):
        to = max(at + 1, int(np.searchsorted(end, start[at] + STRETCH, "right")))
        low, high = start[at], end[to - 1]
        found, piece = places(data[low:high], start[at:to] - low, end[at:to] - low)
        yield found, piece, text[at:to][piece]
        at = to


# ---- random indexing ----


def random_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Where each place's random vector is not zero, and its signs there."""
    rng = np.random.default_rng(SEED)
    where = rng.permuted(np.tile(np.arange(WIDTH), (2**WORD_BITS, 1)), axis=1)[:, :ENTRIES]
    return where, rng.choice([-1.0, 1.0], size=where.shape)


def _add_contexts(total: np.ndarray, words: np.ndarray, piece: np.ndarray, where, signs) -> None:
    """Add to each word's row the vectors of the words beside it, and the word itself to the last column."""
    to, beside = [], []
    for apart in range(1, REACH + 1):
        same = piece[apart:] == piece[:-apart]
        left, right = words[:-apart][same], words[apart:][same]
        to += [left, right]
        beside += [right, left]
    to, beside = np.concatenate(to), np.concatenate(beside)
    width = total.shape[1]
    cells = np.concatenate([(to[:, None] * width + where[beside]).ravel(), words * width + width - 1])
    amounts = np.concatenate([signs[beside].ravel(), np.ones(len(words))])
    total += np.bincount(cells, amounts, minlength=total.size).reshape(total.shape)


def context_sums(docs: DataFrame) -> np.ndarray:
    """For each place the summed vectors of the words beside it and the number of its words.

    The whole corpus is read; the driver gets one row a place.
    """
    where, signs = random_vectors()
    given = docs.sparkSession.sparkContext.broadcast((where, signs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Whole numbers, exact below 2**53.
        total = np.zeros((2**WORD_BITS, WIDTH + 1))
        for batch in batches:
            for words, piece, _ in _stretches(batch.column(0)):
                _add_contexts(total, words, piece, *given.value)
        held = np.flatnonzero(total[:, WIDTH])
        ends = pa.array(np.arange(len(held) + 1) * (WIDTH + 1), pa.int32())
        sums = pa.ListArray.from_arrays(ends, pa.array(total[held].astype(np.int64).ravel()))
        yield pa.record_batch([pa.array(held, pa.int32()), sums], ["place", "sums"])

    parts = docs.select(whole_text().alias("text")).mapInArrow(run, "place int, sums array<long>")
    added = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(WIDTH + 1)]
    found = parts.groupBy("place").agg(*added).toArrow()
    out = np.zeros((2**WORD_BITS, WIDTH + 1), np.int64)
    if found.num_rows:
        table = np.stack([found[f"s{i}"].to_numpy() for i in range(WIDTH + 1)], axis=1)
        out[found["place"].to_numpy()] = table
    return out


@dataclass(frozen=True)
class WordVectors:
    """A unit vector and a weight for each place."""

    vectors: np.ndarray
    weights: np.ndarray

    @classmethod
    def of(cls, sums: np.ndarray) -> WordVectors:
        contexts, counts = sums[:, :WIDTH].astype(float), sums[:, WIDTH].astype(float)
        length = np.linalg.norm(contexts, axis=1, keepdims=True)
        unit = np.divide(contexts, length, out=np.zeros_like(contexts), where=length > 0)
        share = counts / max(counts.sum(), 1.0)
        return cls(unit.astype(np.float32), (RARE / (RARE + share)).astype(np.float32))

    @property
    def size(self) -> int:
        return 2 * WIDTH + 2

    def pool(self, column: pa.Array) -> np.ndarray:
        """Mean and spread of the word vectors of each text, and how often words come again; zeros without words."""
        sums = np.zeros((len(column), 2 * WIDTH + 2))
        distinct = np.zeros(len(column))
        for words, _, text in _stretches(column):
            if not len(words):
                continue
            edges = np.concatenate([[0], np.flatnonzero(np.diff(text)) + 1])
            weight = self.weights[words][:, None]
            rows = self.vectors[words]
            parts = np.concatenate([rows * weight, rows * rows * weight, weight, np.ones_like(weight)], axis=1)
            sums[text[edges]] += np.add.reduceat(parts, edges, axis=0, dtype=np.float64)
            pairs = np.unique(text << WORD_BITS | words)
            distinct += np.bincount(pairs >> WORD_BITS, minlength=len(column))
        total, n = sums[:, -2:-1], sums[:, -1]
        held = np.divide(sums[:, :-2], total, out=np.zeros_like(sums[:, :-2]), where=total > 0)
        mean, square = held[:, :WIDTH], held[:, WIDTH:]
        spread = np.sqrt(np.maximum(square - mean * mean, 0))
        again = np.divide(distinct, n, out=np.zeros_like(n), where=n > 0)
        return np.column_stack([mean, spread, again, np.divide(total[:, 0], n, out=np.zeros_like(n), where=n > 0)])


# ---- network ----


@dataclass(frozen=True)
class Network:
    """Two layers on scaled inputs; ``temperature`` divides the output before it becomes a probability."""

    centre: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    temperature: float = 1.0

    def outputs(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return (np.tanh((x - self.centre) / self.scale @ w1 + b1) @ w2 + b2)[:, 0]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return _chance(self.outputs(x) / self.temperature)


def _chance(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def train(x: np.ndarray, y: np.ndarray, hidden: int = HIDDEN, seed: int = SEED) -> Network:
    """Least cross-entropy by Adam over shuffled batches; the same rows give the same network."""
    rng = np.random.default_rng(seed)
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = (x - centre) / scale
    layers = [
        rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)),
        np.zeros(hidden),
        rng.normal(0, 1 / np.sqrt(hidden), (hidden, 1)),
        np.full(1, np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6))),
    ]
    first, second, step = [0 * p for p in layers], [0 * p for p in layers], 0
    for epoch in range(EPOCHS):
        rate = RATE * 0.5 * (1 + np.cos(np.pi * epoch / EPOCHS))
        order = rng.permutation(len(z))
        for at in range(0, len(z), BATCH):
            rows = order[at : at + BATCH]
            w1, b1, w2, b2 = layers
            h = np.tanh(z[rows] @ w1 + b1)
            d = (_chance((h @ w2 + b2)[:, 0]) - y[rows])[:, None] / len(rows)
            back = (d @ w2.T) * (1 - h * h)
            slopes = [z[rows].T @ back + DECAY * w1, back.sum(axis=0), h.T @ d + DECAY * w2, d.sum(axis=0)]
            step += 1
            for i, g in enumerate(slopes):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                mean, square = first[i] / (1 - 0.9**step), second[i] / (1 - 0.999**step)
                layers[i] = layers[i] - rate * mean / (np.sqrt(square) + 1e-8)
    return Network(centre, scale, layers)


def temperature(z: np.ndarray, y: np.ndarray) -> float:
    """What the outputs are best divided by: least cross-entropy over a grid of powers of two."""
    if not len(z):
        return 1.0

    def loss(t: float) -> float:
        return float(np.mean(np.logaddexp(0, z / t) - y * z / t))

    return min((2.0 ** (k / 8) for k in range(-24, 41)), key=loss)


# ---- documents ----


def _fold(key: Column) -> Column:
    """The fold of a document, null without an id."""
    return F.crc32(key.cast("string")) % FOLDS


def learning_labels(labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, quality, fold) of at most ``fit_rows`` labelled ids that are not held out, spread over all.

    Of an id with several labels the least counts.
    """
    known = labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)")
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    learnt = known.withColumn("fold", _fold(F.col("doc_id"))).filter(F.col("fold") != HELD_OUT)
    return learnt.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)


def _pooled(rows: DataFrame, words: WordVectors) -> DataFrame:
    """(doc_id, quality, fold, x) of labelled documents."""
    given = rows.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = given.value.pool(batch.column(3))
            ends = pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32())
            vectors = pa.ListArray.from_arrays(ends, pa.array(x.ravel()))
            yield pa.record_batch([*batch.columns[:3], vectors], ["doc_id", "quality", "fold", "x"])

    asked = rows.select("doc_id", F.col("quality").cast("int"), F.col("fold").cast("int"), "text")
    return asked.mapInArrow(run, "doc_id long, quality int, fold int, x array<double>")


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> tuple[WordVectors, Network]:
    """Word vectors of the whole corpus, and a network of labelled documents outside the held-out fold.

    Without labels of both kinds every text gets the share of good ones, or one half.
    """
    words = WordVectors.of(context_sums(docs))
    chosen = F.broadcast(learning_labels(labels, fit_rows))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    # One text an id, so that the sample stays as small as its labels.
    labelled = texts.join(chosen, "doc_id").groupBy("doc_id", "quality", "fold").agg(F.min("text").alias("text"))
    found = _pooled(labelled, words).toArrow().sort_by("doc_id")
    y, fold = found["quality"].to_numpy().astype(float), found["fold"].to_numpy()
    if len(set(y.tolist())) < 2:
        share = min(max(float(y.mean()), 0.01), 0.99) if len(y) else 0.5
        size, start = words.size, np.array([np.log(share / (1 - share))])
        flat = [np.zeros((size, 1)), np.zeros(1), np.zeros((1, 1)), start]
        return words, Network(np.zeros(size), np.ones(size), flat)
    x = found["x"].combine_chunks().flatten().to_numpy().reshape(len(y), -1)
    apart = fold == CALIBRATION
    if len(set(y[~apart].tolist())) < 2:
        apart = np.zeros(len(y), bool)
    network = train(x[~apart], y[~apart])
    heat = temperature(network.outputs(x[apart]), y[apart])
    return words, Network(network.centre, network.scale, network.layers, heat)


def score(docs: DataFrame, words: WordVectors, network: Network) -> DataFrame:
    """(doc_id, score) of every row; a text without words has the score of no words."""
    given = docs.sparkSession.sparkContext.broadcast((words, network))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, network = given.value
        for batch in batches:
            scores = network.scores(words.pool(batch.column(1)))
            yield pa.record_batch([batch.column(0), pa.array(scores)], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of (doc_id, text).

    Null texts count as empty. Rows with null or repeated ids are scored each by
    its own text; a null id is not held out. Other columns are not looked at.
    """
    words, network = fit(docs, labels, fit_rows)
    return score(docs, words, network).select(
        "doc_id",
        F.coalesce(_fold(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
