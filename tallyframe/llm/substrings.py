"""Repeated byte strings by a depth-limited radix sort of windows.

Every string of ``width`` bytes is sorted by digits, most significant first, and
only as deep as its width; equal groups at full depth are the repeated strings.
The first digit of a string is the ``GRAM`` bytes at its anchor, the position in
it with the least hash, so strings that overlap share their first digit and one
row stands for all strings of an anchor. The passes are:

1. the gram at the anchor; anchors alone in their group are done;
2. all bytes that the anchor's strings cover; equal rows repeat as a whole;
3. for what differs there, runs of ``RUN`` neighbouring strings: the bytes that
   all strings of the run share, then all bytes that they cover;
4. for runs that differ, each string by itself.

A pass is an aggregate, combined before the shuffle, so a passage that many
documents share is no hot key; groups of one row leave after each pass. Grams
and strings are compared by 64-bit hashes below their digits so far.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import among, id_back, id_of, whole_text, write_out
from tallyframe.llm.shingles import mixed

WIDTH = 400
GRAM = 48
RUN = 32
#: Texts are scanned in pieces of so many window starts; places in a piece fit below the hash.
PIECE_BITS = 19

_BASE = 0x9E3779B97F4A7C15 | 1
_DOC = ["_id", "_k"]
_POWERS: dict[str, np.ndarray] = {}


def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if len(_POWERS.get("up", ())) < count:
        size = 1 << max(16, (count - 1).bit_length())
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            out = np.ones(size, np.uint64)
            out[1:] = np.uint64(base)
            _POWERS[name] = np.multiply.accumulate(out)
    return _POWERS["up"][:count], _POWERS["down"][:count]


class Hashed:
    """Hashes of any stretches of some bytes, from running sums."""

    def __init__(self, data: bytes):
        digits = mixed(np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1))
        up, self.down = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(digits * up[:-1], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start])


def least_of_neighbours(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours, by running minima from both sides of blocks."""
    count = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, 2**64 - 1, np.uint64)
    padded[: len(values)] = values
    table = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])


def anchors(data: bytes, width: int, gram: int) -> tuple[np.ndarray, ...]:
    """(gram hash, hash of all bytes covered, place, first start, last start) of each anchor."""
    found = []
    place = np.uint64((1 << (PIECE_BITS + 1)) - 1)
    for base in range(0, max(len(data) - width + 1, 0), 1 << PIECE_BITS):
        piece = data[base : base + (1 << PIECE_BITS) + width - 1]
        hashed = Hashed(piece)
        at = np.arange(len(piece) - gram + 1)
        grams = hashed.of(at, at + gram)
        # Equal high bits are settled by the place, so that the leftmost wins.
        keys = (grams & ~place) | at.astype(np.uint64)
        where = (least_of_neighbours(keys, width - gram + 1) & place).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(np.diff(where)) + 1])
        last = np.concatenate([first[1:], [len(where)]]) - 1
        own = where[first]
        covered = hashed.of(first, last + width)
        found.append((grams[own], covered, own + base, first + base, last + base))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    return tuple(np.concatenate(x).astype(np.int64) for x in zip(*found, strict=True))


def _bytes(text: str | None) -> bytes:
    return (text or "").encode()


def _scan(docs: DataFrame, width: int, gram: int) -> DataFrame:
    """One row a row of ``docs``: its key, size and digest, and its anchors as arrays."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for text in rows["text"]:
                data = _bytes(text)
                digest = hashlib.sha256(data).hexdigest()
                out.append((len(data), digest, *anchors(data, width, gram)))
            names = ["n", "sha", "g", "ctx", "p", "first", "last"]
            made = pd.DataFrame(out, columns=names)
            made.insert(0, "_k", rows["_k"])
            made.insert(0, "_id", rows["_id"])
            yield made

    text = whole_text()
    rows = docs.select(id_of().alias("_id"), F.xxhash64(text).alias("_k"), text.alias("text"))
    shape = (
        "_id long, _k long, n long, sha string, g array<long>, ctx array<long>, "
        "p array<int>, first array<int>, last array<int>"
    )
    return write_out(rows.mapInPandas(run, shape), "anchors")


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted``, one row a document, with the texts of its documents."""
    texts = docs.select(id_of().alias("_id"), whole_text().alias("text"))
    texts = texts.filter(among(wanted.select("_id"), "_id"))
    return texts.withColumn("_k", F.xxhash64("text")).dropDuplicates(_DOC).join(wanted, _DOC)


def _per_document(rows: DataFrame, *columns: str) -> DataFrame:
    listed = F.collect_list(F.struct(*columns)).alias("rows")
    return rows.groupBy(*_DOC).agg(listed)


def _joined(parts: list[tuple[np.ndarray, ...]], names: list[str]) -> pd.DataFrame:
    """One frame a batch: a frame for each document would cost more than its rows."""
    columns = zip(*parts, strict=True) if parts else [[np.zeros(0, np.int64)]] * len(names)
    return pd.DataFrame({n: np.concatenate(x) for n, x in zip(names, columns, strict=True)})


def _runs(docs: DataFrame, mixed_rows: DataFrame, width: int, run: int) -> DataFrame:
    """Pass 3 digits: rows (g, b, core, all, lo, hi) of each run of each mixed anchor.

    Strings are named by how far their start lies before the anchor; ``lo`` and
    ``hi`` are the least and greatest of these in run ``b``.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for doc, k, text, listed in zip(
                rows["_id"], rows["_k"], rows["text"], rows["rows"], strict=True
            ):
                hashed = Hashed(_bytes(text))
                g, p, first, last = (
                    np.array([x[c] for x in listed], np.int64) for c in ("g", "p", "first", "last")
                )
                low, high = (p - last) // run, (p - first) // run
                times = high - low + 1
                of = np.repeat(np.arange(len(p)), times)
                b = np.arange(len(of)) - np.repeat(np.cumsum(times) - times, times) + low[of]
                lo = np.maximum(b * run, (p - last)[of])
                hi = np.minimum(b * run + run - 1, (p - first)[of])
                at = p[of]
                core = hashed.of(at - b * run, at - (b * run + run - 1) + width)
                everything = hashed.of(at - hi, at - lo + width)
                own = [np.full(len(of), x, np.int64) for x in (doc, k)]
                hashes = [core.astype(np.int64), everything.astype(np.int64)]
                out.append((*own, g[of], at, b, lo, hi, *hashes))
            names = ["_id", "_k", "g", "p", "b", "lo", "hi", "core", "everything"]
            yield _joined(out, names)

    shape = (
        "_id long, _k long, g long, p int, b int, lo int, hi int, core long, everything long"
    )
    wanted = _per_document(mixed_rows, "g", "p", "first", "last")
    return write_out(_texts(docs, wanted).mapInPandas(cut, shape), "runs")


def _singles(docs: DataFrame, rows: DataFrame, width: int) -> DataFrame:
    """Pass 4 digits: (g, l, window) of each string of the runs that differ."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            out = []
            for doc, k, text, listed in zip(
                part["_id"], part["_k"], part["text"], part["rows"], strict=True
            ):
                hashed = Hashed(_bytes(text))
                g, p, lo, hi = (
                    np.array([x[c] for x in listed], np.int64) for c in ("g", "p", "lo", "hi")
                )
                of = np.repeat(np.arange(len(p)), hi - lo + 1)
                times = hi - lo + 1
                far = np.arange(len(of)) - np.repeat(np.cumsum(times) - times, times) + lo[of]
                start = p[of] - far
                window = hashed.of(start, start + width)
                own = [np.full(len(of), x, np.int64) for x in (doc, k)]
                out.append((*own, g[of], far, start, window.astype(np.int64)))
            yield _joined(out, ["_id", "_k", "g", "far", "start", "window"])

    shape = "_id long, _k long, g long, far int, start int, window long"
    wanted = _per_document(rows, "g", "p", "lo", "hi")
    return write_out(_texts(docs, wanted).mapInPandas(cut, shape), "single-strings")


def _several(rows: DataFrame, key: list[str]) -> DataFrame:
    return rows.join(rows.groupBy(*key).count().filter("count > 1").drop("count"), key)


def repeated(docs: DataFrame, scanned: DataFrame, width: int, run: int) -> DataFrame:
    """(_id, _k, start, end): stretches of bytes that are covered by repeated strings."""
    flat = scanned.select(*_DOC, F.explode(F.arrays_zip("g", "ctx", "p", "first", "last")).alias("x"))
    flat = flat.select(*_DOC, "x.*")
    # Pass 1.
    # Written, so that the join can split a hot gram.
    common = write_out(flat.groupBy("g").count().filter("count > 1").select("g"), "shared-grams")
    rows = write_out(flat.join(common, "g", "left_semi"), "grams")
    # Pass 2.
    whole = ["g", "before", "after", "ctx"]
    rows = rows.withColumn("before", F.col("p") - F.col("first"))
    rows = rows.withColumn("after", F.col("p") - F.col("last"))
    kinds = write_out(
        rows.groupBy(*whole).agg(
            F.count("*").alias("times"), F.min(F.struct(*_DOC, "p", "first", "last")).alias("one")
        ),
        "covers",
    )
    stretch = [*_DOC, F.col("first").alias("start"), (F.col("last") + width).alias("end")]
    covered = rows.join(kinds.filter("times > 1").select(*whole), whole).select(*stretch)
    # Pass 3: one row stands for all that are equal.
    differing = write_out(kinds.groupBy("g").count().filter("count > 1").select("g"), "differing")
    open_ = kinds.join(differing, "g", "left_semi").select("g", "one.*")
    runs = _runs(docs, open_, width, run)
    core = ["g", "b", "core"]
    shared = runs.groupBy(*core).agg(
        F.count("*").alias("times"),
        (F.min(F.struct("everything", "lo", "hi")) != F.max(F.struct("everything", "lo", "hi"))).alias(
            "differ"
        ),
    )
    shared = write_out(shared.filter("times > 1").drop("times"), "cores")
    runs = runs.join(shared, core)
    equal = runs.filter("NOT differ").select(
        *_DOC, (F.col("p") - F.col("hi")).alias("start"), (F.col("p") - F.col("lo") + width).alias("end")
    )
    # Pass 4.
    strings = _singles(docs, runs.filter("differ"), width)
    last = _several(strings, ["g", "far", "window"])
    single = last.select(*_DOC, "start", (F.col("start") + width).alias("end"))
    return covered.union(equal).union(single)


def _kept(text: str, stretches: list[dict[str, int]]) -> tuple[bytes, int, int]:
    """What is left, how many bytes go, and in how many runs."""
    data = np.frombuffer(_bytes(text), np.uint8)
    depth = np.zeros(len(data) + 1, np.int64)
    np.add.at(depth, [x["start"] for x in stretches], 1)
    np.add.at(depth, [x["end"] for x in stretches], -1)
    gone = np.cumsum(depth[:-1]) > 0
    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return data[~gone].tobytes(), int(gone.sum()), spans


def dedup(
    docs: DataFrame, width: int = WIDTH, gram: int = GRAM, run: int = RUN, with_text: bool = True
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept: one row a row of ``docs``.

    Each byte goes that a string of ``width`` bytes covers which also starts
    anywhere else. ``kept`` are the remaining bytes (may cut a character). Null
    counts as empty. Rows are documents of their own even where id or text repeat.
    """
    if not 0 < run < width - gram:
        raise ValueError("a run of strings must share more than the gram")
    docs = docs.select("doc_id", "text")
    scanned = _scan(docs, width, gram)
    stretches = repeated(docs, scanned, width, run)
    wanted = write_out(_per_document(stretches, "start", "end"), "stretches")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for text, listed in zip(rows["text"], rows["rows"], strict=True):
                kept, gone, spans = _kept(text, listed)
                digest = hashlib.sha256(kept).hexdigest()
                out.append((gone, spans, digest, kept if with_text else None))
            made = pd.DataFrame(out, columns=["n_removed", "n_spans", "kept_sha256", "kept"])
            made.insert(0, "_k", rows["_k"])
            made.insert(0, "_id", rows["_id"])
            yield made

    shape = "_id long, _k long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    changed = _texts(docs, wanted).mapInPandas(cut, shape)
    here = scanned.select(*_DOC, "n", "sha").join(changed, _DOC, "left")

    def or_zero(column: str) -> Column:
        return F.coalesce(column, F.lit(0)).alias(column)

    found = here.select(
        id_back(F.col("_id")).alias("doc_id"),
        F.col("n").alias("n_bytes"),
        or_zero("n_removed"),
        or_zero("n_spans"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"),
        "kept",
    )
    return found if with_text else found.drop("kept")
