"""Repeated word windows by backward search in a compressed FM-index per shard.

A window is ``WIDTH`` words in a row. Its anchor is the run of ``GRAM`` words in
it with the least hash; windows that share an anchor are neighbours and make one
segment of text. Segments whose anchor occurs in one document only hold nothing
that another document has, and leave first.

Equal segments become one with the least id that holds it, so a passage of a
third of all documents is one row. Segments whose anchor also has other segments
go to shards by their anchor, or, where an anchor has very many, window by
window. Each shard is indexed (suffix array, Burrows-Wheeler transform, wavelet
matrix of packed bits with counts), and the segments are streamed against it:
backward search extends all matches at once, word by word, to the threshold, and
the least id of each remaining interval tells whether a smaller document has the
window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import among, id_back, id_of, release, whole_text, write_out
from tallyframe.llm.shingles import windows
from tallyframe.llm.substrings import least_of_neighbours

WIDTH = 13
GRAM = 5
SHARD_WORDS = 200_000
#: An anchor with more distinct segments is dealt out window by window.
CROWDED = 4_000
BITMAP_BITS = 24
PLACE_BITS = 20

_DOC = ["_id", "_k"]


# ---- the index -----------------------------------------------------------------------


class Bits:
    """A bit vector packed into 64-bit words, with counts before each word."""

    def __init__(self, bits: np.ndarray):
        size = -(-(len(bits) + 1) // 64) * 8
        packed = np.zeros(size, np.uint8)
        some = np.packbits(bits, bitorder="little")
        packed[: len(some)] = some
        self.words = packed.view("<u8")
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(counts)[:-1]])

    def ones(self, at: np.ndarray) -> np.ndarray:
        """How many ones lie before each place."""
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)


class WaveletMatrix:
    """Occurrences of any symbol before any place, one bit vector a level."""

    def __init__(self, symbols: np.ndarray, count: int):
        self.levels = range(max(1, int(count - 1).bit_length()) - 1, -1, -1)
        self.bits, self.zeros = [], []
        now = symbols
        for level in self.levels:
            bit = (now >> level & 1).astype(bool)
            self.bits.append(Bits(bit))
            self.zeros.append(int((~bit).sum()))
            now = np.concatenate([now[~bit], now[bit]])
        every = np.arange(count)
        self.start = self._down(every, np.zeros(count, np.int64))

    def _down(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, bits, zeros in zip(self.levels, self.bits, self.zeros, strict=True):
            ones = bits.ones(at)
            at = np.where(symbols >> level & 1, zeros + ones, at - ones)
        return at

    def before(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self._down(symbols, at) - self.start[symbols]


def suffix_order(text: np.ndarray, first_word: int) -> np.ndarray:
    """Suffixes in order. Symbols below ``first_word`` are all different ends of segments."""
    rank, step = text.astype(np.int64), 1
    while True:
        ahead = np.zeros(len(rank), np.int64)
        ahead[:-step] = rank[step:] + 1 if step < len(rank) else 0
        key = rank * (len(rank) + first_word + 2 + int(rank.max())) + ahead
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        new = np.zeros(len(rank), np.int64)
        new[order] = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        if new.max() == len(rank) - 1:
            return order
        rank, step = new, 2 * step


class FMIndex:
    """Segments of words, each with an id; finds the least id among a window's occurrences."""

    def __init__(self, segments: list[np.ndarray], ids: np.ndarray):
        lengths = np.array([len(s) for s in segments])
        _, words = np.unique(np.concatenate(segments), return_inverse=True)
        count = len(segments)
        ends = np.cumsum(lengths + 1) - 1
        self.text = np.empty(len(words) + count, np.int64)
        inside = np.ones(len(self.text), bool)
        inside[ends] = False
        self.text[inside], self.text[ends] = words + count, np.arange(count)
        self.first = ends - lengths
        order = suffix_order(self.text, count)
        # In the transform all ends are one symbol; searches never ask for it.
        flat = np.maximum(self.text - count + 1, 0)
        symbols = int(flat.max()) + 1
        self.wavelet = WaveletMatrix(flat[order - 1], symbols)
        counts = np.bincount(flat, minlength=symbols)
        self.below = np.concatenate([[0], np.cumsum(counts)[:-1]])
        self.flat = flat
        owner = np.repeat(ids, lengths + 1)[order]
        self.least = [owner]
        while 2 << (len(self.least) - 1) <= len(owner):
            last, step = self.least[-1], 1 << (len(self.least) - 1)
            self.least.append(np.minimum(last[:-step], last[step:]))

    def least_of(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The least id in each interval of the suffix order."""
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(low), np.int64)
        for k in np.unique(level):
            some = level == k
            table, step = self.least[k], 1 << int(k)
            out[some] = np.minimum(table[low[some]], table[high[some] - step])
        return out

    def search(self, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Of windows at ``starts`` in the text: which occur again, and their least id.

        Windows whose match has only one occurrence left are given up, since that
        one is their own.
        """
        active = np.arange(len(starts))
        low = np.zeros(len(starts), np.int64)
        high = np.full(len(starts), len(self.text), np.int64)
        for back in range(width - 1, -1, -1):
            symbol = self.flat[starts[active] + back]
            low = self.below[symbol] + self.wavelet.before(symbol, low)
            high = self.below[symbol] + self.wavelet.before(symbol, high)
            several = high - low > 1
            active, low, high = active[several], low[several], high[several]
        return active, self.least_of(low, high)


# ---- segments ------------------------------------------------------------------------


def anchored(hashes: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, ...]:
    """(anchor hash, first window, last window) of each segment."""
    found = []
    place = np.uint64((1 << PLACE_BITS) - 1)
    piece = 1 << (PLACE_BITS - 1)
    for base in range(0, max(len(hashes) - width + 1, 0), piece):
        grams = windows(hashes[base : base + piece + width - 1], gram)
        keys = (grams & ~place) | np.arange(len(grams), dtype=np.uint64)
        where = (least_of_neighbours(keys, width - gram + 1) & place).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(np.diff(where)) + 1])
        last = np.concatenate([first[1:], [len(where)]]) - 1
        found.append((grams[where[first]], first + base, last + base))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    return tuple(np.concatenate(x).astype(np.int64) for x in zip(*found, strict=True))


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _anchors(docs: DataFrame, width: int, gram: int) -> DataFrame:
    """(_id, g): the anchors of each document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            rows["g"] = [
                np.unique(anchored(_hashes(t.encode().split()), width, gram)[0])
                for t in rows.pop("text")
            ]
            yield rows

    listed = docs.select("_id", "text").mapInPandas(run, "_id long, g array<long>")
    return listed.select("_id", F.explode("g").alias("g"))


def _bitmap(keys: DataFrame) -> np.ndarray:
    """One bit for each low part of a key: as large for any input."""
    at = F.col("g").bitwiseAND(2**BITMAP_BITS - 1)
    rows = (
        keys.select(F.floor(at / 64).cast("int").alias("w"), (at % 64).cast("int").alias("b"))
        .selectExpr("w", "shiftleft(1L, b) AS v")
        .groupBy("w")
        .agg(F.bit_or("v").alias("v"))
        .toPandas()
    )
    out = np.zeros(2 ** (BITMAP_BITS - 6), np.int64)
    out[rows["w"].to_numpy(np.int64)] = rows["v"].to_numpy(np.int64)
    return out.view(np.uint64)


def _segments(docs: DataFrame, bitmap: np.ndarray, width: int, gram: int) -> DataFrame:
    """One row a document: its size, digest, and the segments whose anchor others may have."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = shared.value
        for rows in batches:
            out = []
            for text in rows.pop("text"):
                words = text.encode().split()
                g, first, last = anchored(_hashes(words), width, gram)
                at = g & (2**BITMAP_BITS - 1)
                some = np.flatnonzero(bits[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1))
                g, first, last = g[some], first[some], last[some]
                segments = [
                    b" ".join(words[a : b + width]) for a, b in zip(first, last, strict=True)
                ]
                key = np.fromiter(map(xxhash.xxh3_64_intdigest, segments), np.uint64, len(segments))
                digest = hashlib.sha256(b" ".join(words)).hexdigest()
                out.append((len(words), digest, g, first, last, key.astype(np.int64)))
            names = ["n", "sha", "g", "first", "last", "key"]
            made = pd.DataFrame(out, columns=names)
            made.insert(0, "_k", rows["_k"])
            made.insert(0, "_id", rows["_id"])
            yield made

    shape = (
        "_id long, _k long, n long, sha string, g array<long>, first array<int>, "
        "last array<int>, key array<long>"
    )
    return write_out(docs.mapInPandas(run, shape), "segments")


def _with_text(docs: DataFrame, kinds: DataFrame, width: int) -> DataFrame:
    """(g, key, d, owner, segment): the words of segments, cut out of their owners' texts."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for owner, text, listed in zip(rows["_id"], rows["text"], rows["rows"], strict=True):
                words = text.encode().split()
                for x in listed:
                    segment = b" ".join(words[x["first"] : x["last"] + width]).decode()
                    out.append((x["g"], x["key"], x["d"], owner, segment))
            yield pd.DataFrame(out, columns=["g", "key", "d", "owner", "segment"])

    wanted = kinds.groupBy(*_DOC).agg(
        F.collect_list(F.struct("g", "key", "d", "first", "last")).alias("rows")
    )
    shape = "g long, key long, d long, owner long, segment string"
    return write_out(_texts(docs, wanted).mapInPandas(cut, shape), "open-kinds")


def _searched(rows: DataFrame, width: int, shard_words: int) -> DataFrame:
    """(g, key, owner, o, least, lone) for windows ``o`` of segments that occur again in their shard."""
    # The widest segment has two windows less than twice the width.
    shards = -(-rows.count() * (2 * width) // shard_words) or 1
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("g"), F.lit(shards)))

    names = ["g", "key", "owner", "o", "least", "lone"]

    def run(part: pd.DataFrame) -> pd.DataFrame:
        segments = [_hashes(s.encode().split()) for s in part["segment"]]
        index = FMIndex(segments, part["owner"].to_numpy())
        count = np.array([len(s) - width + 1 for s in segments])
        of = np.repeat(np.arange(len(segments)), count)
        o = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
        again, least = index.search(index.first[of] + o, width)
        of, o = of[again], o[again]
        found = part[["g", "key", "owner", "lone"]].iloc[of].reset_index(drop=True)
        return found.assign(o=o.astype(np.int32), least=least)[names]

    return write_out(
        dealt.groupBy("shard").applyInPandas(
            run, "g long, key long, owner long, o int, least long, lone boolean"
        ),
        "searched",
    )


def _windows_of_crowded(kinds: DataFrame, width: int) -> DataFrame:
    """(g, key, owner, o, window, wkey): the segments of crowded anchors, window by window."""
    words = F.split("segment", " ")
    at = F.explode(F.sequence(F.lit(0), F.size("words") - width)).alias("o")
    cut = kinds.withColumn("words", words).select("g", "key", "owner", "words", at)
    window = F.array_join(F.slice("words", F.col("o") + 1, width), " ")
    cut = cut.select("g", "key", "owner", "o", window.alias("window"))
    return cut.withColumn("wkey", F.xxhash64("window"))


def repeated(
    docs: DataFrame, found: DataFrame, width: int, shard_words: int, crowded: int
) -> DataFrame:
    """(_id, _k, start, end): words covered by windows that a smaller id has."""
    zipped = F.explode(F.arrays_zip("g", "key", "first", "last")).alias("x")
    flat = found.select(*_DOC, zipped).select(*_DOC, "x.*")
    kinds = flat.groupBy("g", "key").agg(
        F.min(F.struct(*_DOC, "first", "last")).alias("one"), F.max("_id").alias("largest")
    )
    kinds = write_out(kinds, "kinds")
    release(docs.sparkSession)
    # Written, so that a crowded anchor can be split in the join.
    number = kinds.groupBy("g").agg(F.count("*").alias("d")).filter("d > 1")
    number = write_out(number, "open-anchors")
    open_ = _with_text(docs, kinds.join(number, "g").select("g", "key", "d", "one.*"), width)
    release(docs.sparkSession)
    plain = open_.filter(F.col("d") <= crowded)
    cut = _windows_of_crowded(open_.filter(F.col("d") > crowded), width)
    # Of equal windows, the least and the largest id stand for all.
    single = cut.groupBy("window", "wkey").agg(F.min("owner").alias("a"), F.max("owner").alias("b"))
    single = single.filter("b > a").select("window", "wkey", F.explode(F.array("a", "b")).alias("id"))
    rows = plain.select("g", "key", "segment", "owner", F.lit(False).alias("lone")).union(
        single.select("wkey", "wkey", "window", "id", F.lit(True))
    )
    searched = _searched(rows, width, shard_words).filter("owner > least")
    hits = searched.filter("NOT lone").select("g", "key", "owner", "o")
    lone = searched.filter("lone").select(F.col("key").alias("wkey"), "least").distinct()
    by_window = cut.join(lone, "wkey").filter("owner > least").select("g", "key", "owner", "o")
    hits = hits.union(by_window)
    hits = write_out(hits, "hits")
    release(docs.sparkSession)
    # Rows of a later document go as a whole, rows of the owner where a smaller one has the window.
    whole = kinds.filter("largest > one._id").select(
        "g", "key", F.col("one._id").alias("owner"), F.lit(None).cast("int").alias("o")
    )
    met = flat.join(whole.union(hits.select("g", "key", "owner", "o")), ["g", "key"])
    later = F.col("o").isNull()
    met = met.filter((later & (F.col("_id") > F.col("owner"))) | (~later & (F.col("_id") == F.col("owner"))))
    start = F.when(later, F.col("first")).otherwise(F.col("first") + F.col("o"))
    end = F.when(later, F.col("last")).otherwise(F.col("first") + F.col("o")) + width
    return met.select(*_DOC, start.alias("start"), end.alias("end"))


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted``, one row a document, with the texts of its documents."""
    texts = docs.filter(among(wanted.select("_id"), "_id")).dropDuplicates(_DOC)
    return texts.join(wanted, _DOC)


def dedup(
    docs: DataFrame,
    width: int = WIDTH,
    gram: int = GRAM,
    shard_words: int = SHARD_WORDS,
    crowded: int = CROWDED,
    with_text: bool = True,
) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, intervals, kept: one row a row of ``docs``.

    Each word goes that a window covers whose words also start in a document of a
    smaller id. ``intervals`` are the removed runs of words as (start, end), and
    ``kept`` is what is left, joined by one blank. Null counts as empty, a missing
    id as the largest. Rows of one id are one document: they take nothing from
    each other.
    """
    if not 0 < gram < width:
        raise ValueError("an anchor must be shorter than a window")
    text = whole_text()
    docs = docs.select(id_of().alias("_id"), F.xxhash64(text).alias("_k"), text.alias("text"))
    grams = _anchors(docs, width, gram).groupBy("g").agg(F.min("_id").alias("a"), F.max("_id").alias("b"))
    shared = write_out(grams.filter("a < b").select("g"), "shared-anchors")
    found = _segments(docs, _bitmap(shared), width, gram)
    release(docs.sparkSession)
    stretches = repeated(docs, found, width, shard_words, crowded)
    wanted = write_out(
        stretches.groupBy(*_DOC).agg(F.collect_set(F.struct("start", "end")).alias("rows")), "covered"
    )
    release(docs.sparkSession)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for text, listed in zip(rows["text"], rows["rows"], strict=True):
                words = text.encode().split()
                depth = np.zeros(len(words) + 1, np.int64)
                np.add.at(depth, [x["start"] for x in listed], 1)
                np.add.at(depth, [x["end"] for x in listed], -1)
                gone = np.cumsum(depth[:-1]) > 0
                left = b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g)
                edge = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]])))
                runs = [{"start": a, "end": b} for a, b in edge.reshape(-1, 2).tolist()]
                digest = hashlib.sha256(left).hexdigest()
                out.append((int(gone.sum()), digest, runs, left.decode() if with_text else None))
            made = pd.DataFrame(out, columns=["n_removed", "kept_sha256", "intervals", "kept"])
            made.insert(0, "_k", rows["_k"])
            made.insert(0, "_id", rows["_id"])
            yield made

    shape = (
        "_id long, _k long, n_removed long, kept_sha256 string, "
        "intervals array<struct<start:int,end:int>>, kept string"
    )
    changed = _texts(docs, wanted).mapInPandas(cut, shape)
    here = found.select(*_DOC, "n", "sha").join(changed, _DOC, "left")
    none = F.array().cast("array<struct<start:int,end:int>>")
    result = here.select(
        id_back(F.col("_id")).alias("doc_id"),
        F.col("n").alias("n_words"),
        F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"),
        F.coalesce("intervals", none).alias("intervals"),
        "kept",
    )
    return result if with_text else result.drop("kept")
