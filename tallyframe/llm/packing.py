"""Best-fit packing into sequences of several permitted lengths.

Documents are spread over shards of a bounded number of pieces, and each shard
is packed by itself, longest piece first. A piece goes to the open bin that it
leaves with the least room. If no bin takes it, a new bin is opened: for every
permitted length the fill that the shard's remaining pieces would give is worked
out, and the length with the least cost a token is opened. At the end every bin
shrinks to the least permitted length that still holds its contents.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import id_back, id_of, whole_text, words_of, write_out

CAPACITIES = (512, 1024, 2048, 4096)
#: What a bin costs besides its length, in tokens.
BIN_COST = 32
SHARD_PIECES = 20_000


def _fill(lengths: list[int], counts: dict[int, int], room: int) -> int:
    """Tokens that the remaining pieces put into ``room``, largest fitting first."""
    taken: dict[int, int] = {}
    filled, end = 0, len(lengths)
    while room > 0:
        end = bisect_right(lengths, room, 0, end)
        if not end:
            break
        length = lengths[end - 1]
        use = min(counts[length] - taken.get(length, 0), room // length)
        taken[length] = use
        filled += use * length
        room -= use * length
        end -= 1
    return filled


def pack(lengths: Sequence[int], capacities: Sequence[int], bin_cost: int = BIN_COST):
    """(bin, offset) of each length, given in descending order, and the bins' capacities."""
    sizes = sorted(set(capacities))
    counts: dict[int, int] = {}
    for n in lengths:
        counts[n] = counts.get(n, 0) + 1
    left = sorted(counts)
    rooms: list[tuple[int, int]] = []
    used: list[int] = []
    placed: list[tuple[int, int]] = []
    for n in lengths:
        counts[n] -= 1
        if not counts[n]:
            del left[bisect_left(left, n)]
        at = bisect_left(rooms, (n, -1))
        if at < len(rooms):
            room, which = rooms.pop(at)
        else:

            def cost(size: int, n: int = n) -> tuple[float, int]:
                return (size + bin_cost) / (n + _fill(left, counts, size - n)), size

            room, which = min((s for s in sizes if s >= n), key=cost), len(used)
            used.append(0)
        placed.append((which, used[which]))
        used[which] += n
        if room > n:
            insort(rooms, (room - n, which))
    return placed, [sizes[bisect_left(sizes, u)] for u in used]


def lengths_of(docs: DataFrame) -> DataFrame:
    """(_id, _k, n): how many words each text has, for texts that have any, and a hash of the text."""
    text = whole_text()
    counted = docs.select(
        id_of().alias("_id"), F.xxhash64(text).alias("_k"), F.size(words_of(text)).alias("n")
    )
    return counted.filter("n > 0")


def pieces(lengths: DataFrame, most: int) -> DataFrame:
    """(_id, _k, piece, start, length, _copy): texts longer than ``most`` are cut.

    Rows that are equal in all that is packed are numbered, so that they spread
    over the shards as well.
    """
    n = F.col("n")
    starts = F.sequence(F.lit(0), n - 1, F.lit(most))
    length = F.least(F.lit(most), n - F.col("start"))
    return (
        lengths.groupBy("_id", "_k", "n")
        .agg(F.count("*").alias("_times"))
        .select("_id", "_k", "n", F.explode(F.sequence(F.lit(1), F.col("_times"))).alias("_copy"))
        .select("_id", "_k", "n", "_copy", F.posexplode(starts).alias("piece", "start"))
        .select("_id", "_k", "piece", "start", length.alias("length"), "_copy")
    )


def pack_documents(
    docs: DataFrame,
    capacities: Sequence[int] = CAPACITIES,
    bin_cost: int = BIN_COST,
    shard_pieces: int = SHARD_PIECES,
) -> DataFrame:
    """One row a piece: doc_id, text_key, piece, start, length, bin_id, bin_capacity, bin_offset.

    Lengths are words. ``text_key`` is a hash of the text, which tells rows that
    share an id apart. Documents without words have no row. Longer ones than the
    largest capacity are cut into pieces of it and a rest. Repeated ids and rows
    are packed each; a null id is an id like others. Shards are dealt by a hash
    of id, text and piece, and of the number of a copy, so no id can fill one. The same documents give the same bins however they are partitioned.
    """
    sizes = sorted({int(c) for c in capacities})
    if not sizes or sizes[0] < 1:
        raise ValueError("capacities must be positive")
    lengths = write_out(lengths_of(docs), "lengths")
    total = lengths.agg(F.sum(F.ceil(F.col("n") / sizes[-1])).alias("n")).first()["n"] or 0
    shards = -(-total // shard_pieces) or 1
    shard = F.pmod(F.xxhash64("_id", "_k", "piece", "_copy"), F.lit(shards))

    def pack_shard(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(
            ["length", "_id", "_k", "piece", "_copy"], ascending=[False, True, True, True, True]
        )
        placed, bins = pack(rows["length"].tolist(), sizes, bin_cost)
        rows["bin_id"] = [f"{key[0]}-{which}" for which, _ in placed]
        rows["bin_capacity"] = [bins[which] for which, _ in placed]
        rows["bin_offset"] = [offset for _, offset in placed]
        return rows.drop(columns=["_shard", "_copy"])

    packed = (
        pieces(lengths, sizes[-1])
        .withColumn("_shard", shard)
        .groupBy("_shard")
        .applyInPandas(
            pack_shard,
            "_id long, _k long, piece int, start int, length int, "
            "bin_id string, bin_capacity int, bin_offset int",
        )
    )
    own = [id_back(F.col("_id")).alias("doc_id"), F.col("_k").alias("text_key")]
    return packed.select(*own, *packed.columns[2:])


def sequences(docs: DataFrame, placed: DataFrame) -> DataFrame:
    """The packed texts: bin_id, bin_capacity, and its pieces' words joined in order.

    ``docs`` are the documents that were packed. Texts are found by id and text,
    so rows that share an id each give their own words, copies as often as there are.
    """
    text = whole_text()
    texts = docs.select(id_of().alias("_id"), F.xxhash64(text).alias("_k"), text.alias("_text"))
    texts = texts.dropDuplicates(["_id", "_k"])
    pieces_ = placed.select(
        id_of().alias("_id"), F.col("text_key").alias("_k"), "start", "length",
        "bin_id", "bin_capacity", "bin_offset",
    )
    piece = F.array_join(F.slice(words_of(F.col("_text")), F.col("start") + 1, F.col("length")), " ")
    parts = pieces_.join(texts.hint("merge"), ["_id", "_k"]).select(
        "bin_id", "bin_capacity", F.struct("bin_offset", piece.alias("text")).alias("_part")
    )
    held = parts.groupBy("bin_id", "bin_capacity").agg(
        F.sort_array(F.collect_list("_part")).alias("_parts")
    )
    return held.select("bin_id", "bin_capacity", F.array_join("_parts.text", " ").alias("text"))
