"""Near-duplicate join on word shingles by chosen paths.

Texts with equal shingle sets form a class, and one text stands for it. Classes
are numbered, since rows may share an id and those without one all do. The set
is embedded as ``COORDINATES`` MinHash values. In each run, every node of a tree
chooses ``CHILDREN`` coordinates by a hash of its path, and a set moves to the
child that its value at the coordinate names. Buckets are split until they are
small, or until a child keeps most of its parent, which is how a group of copies
looks; what is left is compared by brute force, large buckets in blocks so that
no task meets more than two blocks at once.

Two sets of similarity s meet below a node with chance q = 1 - (1 - s q)^2, or
more, whatever the depth; runs are repeated until the recall at the threshold is
at least ``recall``. A pair that meets in several buckets is counted in the first
one only. Pairs never leave a task: a block gives each of its texts its number of
links and one link to the least text it is connected to.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import by_own_names, id_back, id_of, set_apart, whole_text, write_out
from tallyframe.llm.components import components
from tallyframe.llm.shingles import (
    SHINGLE,
    group_edges,
    mixed,
    shingle_set,
    whole_groups,
)

THRESHOLD = 0.8
RECALL = 0.9999
COORDINATES = 64
CHILDREN = 2
SMALL = 64
DENSE = 0.5
MAX_DEPTH = 6
BLOCK_ROWS = 1024
BLOCK_SHINGLES = 4_000_000
#: The share of pairs at the threshold that the screen by embeddings may lose.
SCREEN_LOSS = 3e-7

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = mixed(np.arange(1, COORDINATES + 1, dtype=np.uint64) * _GOLD) | np.uint64(1)
KEY = ["leaf", "i", "j"]
DOC = ["_id", "_text"]
SAME = ["n", "s0", "s1"]


# ---- sketches ------------------------------------------------------------------------


def sketch(hashes: np.ndarray) -> np.ndarray:
    """MinHash values of a set; those of the empty set are all zero."""
    out = np.full(COORDINATES, 2**64 - 1 if len(hashes) else 0, np.uint64)
    for at in range(0, len(hashes), 4096):
        part = hashes[at : at + 4096, None] * _SEEDS
        np.minimum(out, (part ^ (part >> np.uint64(29))).min(axis=0), out=out)
    return mixed(out).astype(np.uint32).view(np.int32)


def _signature(hashes: np.ndarray) -> tuple[int, int]:
    one = int(mixed(hashes + _GOLD).sum(dtype=np.uint64))
    two = int(np.bitwise_xor.reduce(mixed(hashes * _GOLD), initial=np.uint64(0)))
    return one - 2**63, two - 2**63


def _keyed(docs: DataFrame, *columns: str | Column) -> DataFrame:
    """``columns`` with the id and the text's hash."""
    return docs.select(*columns, id_of().alias("_id"), F.xxhash64(whole_text()).alias("_text"))


def sketches(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """(_id, _text, n, s0, s1, sketch) of every row: size, signature and embedding of its set."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for text in rows["text"]:
                hashes = shingle_set(text, width)
                out.append((len(hashes), *_signature(hashes), sketch(hashes)))
            made = pd.DataFrame(out, columns=["n", "s0", "s1", "sketch"])
            made.insert(0, "_id", rows["_id"])
            made.insert(1, "_text", rows["_text"])
            yield made

    rows = _keyed(docs, whole_text().alias("text"))
    shape = "_id long, _text long, n long, s0 long, s1 long, sketch array<int>"
    return write_out(rows.mapInPandas(run, shape), "sketches")


# ---- paths ---------------------------------------------------------------------------


def screen_for(threshold: float, loss: float = SCREEN_LOSS) -> int:
    """How many coordinates must agree, so that a pair at the threshold fails with chance ``loss`` at most.

    Each coordinate of two sets agrees with the chance of their similarity, by
    itself: the quantile of a binomial distribution.
    """
    below = 0.0
    for agree in range(COORDINATES + 1):
        below += math.comb(COORDINATES, agree) * threshold**agree * (1 - threshold) ** (COORDINATES - agree)
        if below > loss:
            return agree
    return COORDINATES


def runs_for(recall: float, threshold: float) -> int:
    """How many runs find a pair at the threshold with chance ``recall``."""
    # The fixed point of q = 1 - (1 - s q)^2.
    met = max(0.05, (2 * threshold - 1) / threshold**2)
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - met)))


def _children(rows: DataFrame) -> DataFrame:
    """(rep, slot, path, parent) one level below rows of (rep, slot, path, sketch)."""
    which = F.sequence(F.lit(0), F.lit(CHILDREN - 1))
    here = rows.select("rep", "slot", "path", "sketch", F.explode(which).alias("k"))
    at = F.pmod(F.xxhash64("path", "k", F.lit(7)), F.lit(COORDINATES)).cast("int")
    return here.select(
        "rep",
        (F.col("slot") * CHILDREN + F.col("k")).alias("slot"),
        F.xxhash64("path", "k", F.get("sketch", at)).alias("path"),
        F.col("path").alias("parent"),
    )


def leaves(reps: DataFrame, recall: float, threshold: float) -> DataFrame:
    """(leaf, slot, rep, m, total): the buckets that are left for brute force, with their sizes.

    ``slot`` numbers the choices that lead to a bucket; two sets that share it lie
    in it by the same choices.
    """
    runs = runs_for(recall, threshold)
    roots = F.explode(F.sequence(F.lit(1), F.lit(runs)))
    now = reps.filter("n > 0").select("rep", "sketch", roots.alias("slot"))
    now = now.withColumn("path", F.xxhash64("slot"))
    # One bit for each level leads the choices, so that slots of different depths differ.
    now = now.withColumn("slot", F.col("slot").cast("long") + runs)
    found: list[DataFrame] = []
    sizes: DataFrame | None = None
    for depth in range(MAX_DEPTH):
        level = write_out(_children(now), "paths")
        counted = (
            level.join(reps.select("rep", "n"), "rep")
            .groupBy("path", "parent")
            .agg(F.count("*").alias("m"), F.sum("n").alias("total"))
            .filter("m > 1")
        )
        small = F.col("m") <= SMALL
        if sizes is not None:
            above = sizes.select(F.col("path").alias("parent"), F.col("m").alias("above"))
            counted = counted.join(above, "parent")
            small = small | (F.col("m") > DENSE * F.col("above"))
        if depth == MAX_DEPTH - 1:
            small = F.lit(True)
        sizes = write_out(counted.select("path", "m", "total", small.alias("done")), "path-sizes")
        here = level.join(sizes, "path")
        found.append(here.filter("done").select(F.col("path").alias("leaf"), "slot", "rep", "m", "total"))
        sizes = sizes.filter("NOT done")
        if sizes.isEmpty():
            break
        large = level.join(sizes.select("path"), "path").select("rep", "slot", "path")
        now = large.join(reps.select("rep", "sketch"), "rep")
    whole = found[0]
    for part in found[1:]:
        whole = whole.union(part)
    return write_out(whole, "leaves")


def cells(reps: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of (leaf, i, j, block, rep, sketch, slots, leaves): the blocks to compare.

    A bucket of more than ``BLOCK_ROWS`` texts, or of too many shingles for one
    task, is cut into blocks; cell (i, j) holds blocks i and j of it.
    """
    own = found.groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("slot", "leaf"))).alias("l"))
    blocks = F.greatest(
        F.ceil(F.col("m") / BLOCK_ROWS), F.ceil(F.col("total") / BLOCK_SHINGLES)
    ).cast("int")
    dealt = found.select("leaf", "slot", "rep", blocks.alias("g"))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("rep", "leaf"), F.col("g")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("g") - 1)).alias("other")
    dealt = dealt.select("leaf", "slot", "rep", "block", other)
    b, o = F.col("block"), F.col("other")
    return (
        dealt.join(own, "rep")
        .join(reps.select("rep", "sketch"), "rep")
        .select(
            "leaf",
            F.least(b, o).alias("i"),
            F.greatest(b, o).alias("j"),
            "slot",
            "block",
            "rep",
            "sketch",
            F.col("l.slot").alias("slots"),
            F.col("l.leaf").alias("leaves"),
        )
    )


# ---- blocks --------------------------------------------------------------------------

_TRIANGLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _pairs(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs of a cell: within its block, or across its two blocks."""
    if rows["i"].iloc[0] != rows["j"].iloc[0]:
        first = rows["block"].to_numpy() == rows["i"].iloc[0]
        a, b = np.flatnonzero(first), np.flatnonzero(~first)
        return np.repeat(a, len(b)), np.tile(b, len(a))
    if len(rows) not in _TRIANGLES:
        _TRIANGLES[len(rows)] = np.triu_indices(len(rows), 1)
    return _TRIANGLES[len(rows)]


def _meet_first(rows: pd.DataFrame, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs meet in this bucket first, by the order of slots."""
    slots = sorted({s for one in rows["slots"] for s in one})
    column = {s: k for k, s in enumerate(slots)}
    where = np.zeros((len(rows), len(slots)), np.int64)
    for r, (own, leaf) in enumerate(zip(rows["slots"], rows["leaves"], strict=True)):
        where[r, [column[s] for s in own]] = leaf
    here, out = column[rows["slot"].iloc[0]], np.zeros(len(a), bool)
    for at in range(0, len(a), 65_536):
        x, y = where[a[at : at + 65_536]], where[b[at : at + 65_536]]
        out[at : at + 65_536] = ((x == y) & (x != 0)).argmax(axis=1) == here
    return out


def _screened(rows: pd.DataFrame, agree: int) -> np.ndarray:
    """Positions of rows with a likely partner that they meet here first."""
    a, b = _pairs(rows)
    values = np.stack(rows["sketch"].to_numpy())
    keep = np.zeros(len(a), bool)
    for at in range(0, len(a), 32_768):
        same = values[a[at : at + 32_768]] == values[b[at : at + 32_768]]
        keep[at : at + 32_768] = same.sum(axis=1) >= agree
    a, b = a[keep], b[keep]
    if len(a):
        first = _meet_first(rows, a, b)
        a, b = a[first], b[first]
    return np.unique(np.concatenate([a, b]))


def screen(rows: DataFrame, threshold: float) -> DataFrame:
    """The rows of cells that need their whole sets."""
    agree = screen_for(threshold)
    kept = [*KEY, "slot", "block", "rep", "slots", "leaves"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in whole_groups(batches, KEY):
            edges = group_edges(part, KEY)
            chosen = [
                start + _screened(part.iloc[start:end], agree)
                for start, end in zip(edges[:-1], edges[1:], strict=True)
                if end - start > 1
            ]
            if chosen:
                yield part.iloc[np.concatenate(chosen)][kept]

    shape = (
        "leaf long, i int, j int, slot long, block int, rep long, "
        "slots array<long>, leaves array<long>"
    )
    dealt = rows.repartition(*KEY).sortWithinPartitions(*KEY)
    return write_out(dealt.mapInPandas(run, shape), "likely")


def _common(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of pairs of sets."""
    if len(a) <= 2 * len(sets):
        return np.array(
            [len(np.intersect1d(sets[x], sets[y], True)) for x, y in zip(a, b, strict=True)], np.int64
        )
    tokens, inverse, times = np.unique(
        np.concatenate(sets), return_inverse=True, return_counts=True
    )
    shared = np.flatnonzero(times > 1)
    column = np.full(len(tokens), -1)
    column[shared] = np.arange(len(shared))
    place = column[inverse]
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    total = np.zeros((len(sets), len(sets)), np.float32)
    for at in range(0, len(shared), 4_096):
        dense = np.zeros((len(sets), min(4_096, len(shared) - at)), np.float32)
        inside = (place >= at) & (place < at + 4_096)
        dense[row[inside], place[inside] - at] = 1
        total += dense @ dense.T
    return total[a, b].astype(np.int64)


def _least_roots(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least position that each is connected to."""
    root = np.arange(count)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _verified(rows: pd.DataFrame, threshold: float, width: int) -> pd.DataFrame | None:
    """(rep, links, root) of the rows of a cell that have links."""
    rows = rows.sort_values("rep", ignore_index=True)
    sets = [shingle_set(text, width) for text in rows["text"]]
    a, b = _pairs(rows)
    reps = rows["rep"].to_numpy()
    other = reps[a] != reps[b]
    a, b = a[other], b[other]
    sizes = np.array([len(s) for s in sets])
    near = np.minimum(sizes[a], sizes[b]) >= threshold * np.maximum(sizes[a], sizes[b])
    a, b = a[near], b[near]
    if not len(a):
        return None
    first = _meet_first(rows, a, b)
    a, b = a[first], b[first]
    common = _common(sets, a, b)
    linked = common >= threshold * (sizes[a] + sizes[b] - common) - 1e-9
    a, b = a[linked], b[linked]
    if not len(a):
        return None
    links = np.bincount(a, minlength=len(rows)) + np.bincount(b, minlength=len(rows))
    root = _least_roots(len(rows), a, b)
    some = links > 0
    return pd.DataFrame({"rep": reps[some], "links": links[some], "root": reps[root[some]]})


def links(
    docs: DataFrame, classes: DataFrame, likely: DataFrame, threshold: float, width: int
) -> DataFrame:
    """(rep, links, root) by exact similarity of the whole texts of likely rows."""
    # One text of an id however often it comes, reduced before it is shuffled.
    texts = _keyed(docs, whole_text().alias("text")).dropDuplicates(DOC)
    rows = likely.join(classes.select("rep", *DOC), "rep").join(texts, DOC).drop(*DOC)
    rows = rows.repartition(*KEY).sortWithinPartitions(*KEY)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in whole_groups(batches, KEY):
            part = part.drop_duplicates([*KEY, "rep", "text"], ignore_index=True)
            edges = group_edges(part, KEY)
            for start, end in zip(edges[:-1], edges[1:], strict=True):
                found = _verified(part.iloc[start:end], threshold, width) if end - start > 1 else None
                if found is not None:
                    yield found

    return write_out(rows.mapInPandas(run, "rep long, links long, root long"), "links")


def _classes(
    docs: DataFrame, threshold: float, recall: float, width: int
) -> tuple[DataFrame, DataFrame]:
    """The sketches of all rows, and their classes.

    A class has its first id and text (_id, _text), and those of the class it is
    connected to that has the first of all (top).
    """
    rows = sketches(docs, width)
    classes = rows.groupBy(*SAME).agg(
        F.min(F.struct(*DOC, "sketch")).alias("first"), F.count("*").alias("n_copies")
    )
    number = F.monotonically_increasing_id().alias("rep")
    classes = write_out(classes.select(*SAME, "n_copies", "first.*", number), "classes")
    reps = classes.select("rep", "n", "sketch")
    likely = screen(cells(reps, leaves(reps, recall, threshold)), threshold)
    linked = links(docs, classes, likely, threshold, width)
    roots = components(linked.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    counts = linked.groupBy("rep").agg(F.sum("links").alias("n_links"))
    tops = (
        roots.withColumnRenamed("node", "rep")
        .join(classes.select("rep", *DOC), "rep")
        .groupBy("root")
        .agg(F.min(F.struct(*DOC)).alias("top"))
    )
    tops = roots.join(write_out(tops, "tops"), "root").select(F.col("node").alias("rep"), "top")
    known = classes.drop("sketch").join(counts, "rep", "left").join(tops, "rep", "left")
    return rows, known.withColumn("top", F.coalesce("top", F.struct(*DOC)))


def join(
    docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, width: int = SHINGLE
) -> DataFrame:
    """doc_id, class_id, copy_of, n_copies, n_links: one row a row of ``docs``.

    ``copy_of`` is the least id of the texts with the same shingles, ``n_copies``
    their number, ``n_links`` the number of other shingle sets at similarity
    ``threshold`` or more, and ``class_id`` the least id that is reached over links.
    Texts without words are copies of each other and have no links; texts shorter
    than a shingle are one shingle. Null counts as empty, a missing id as the
    largest; rows that share an id, or have none, are linked each by its own text.
    """
    rows, known = _classes(docs.select("doc_id", "text"), threshold, recall, width)
    classes = known.select(*SAME, F.col("_id").alias("copy"), "top", "n_copies", "n_links")
    return rows.select("_id", *SAME).join(classes, SAME).select(
        id_back(F.col("_id")).alias("doc_id"),
        id_back(F.col("top._id")).alias("class_id"),
        id_back(F.col("copy")).alias("copy_of"),
        "n_copies",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


def one_of_each(
    docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, width: int = SHINGLE
) -> DataFrame:
    """One row of ``docs`` of each class, of the least id; all columns stay.

    Rows without an id are told apart by their texts. Of rows of one id and text
    any one stays.
    """
    _, known = _classes(docs.select("doc_id", "text"), threshold, recall, width)
    kept = known.filter(F.col("top") == F.struct(*DOC)).select(*DOC)
    # Copies go before the rows are shuffled, so that an empty text without an id is no hot key.
    docs, back = set_apart(docs, ["doc_id", "text"])
    rows = _keyed(docs, *docs.columns).dropDuplicates(DOC)
    return rows.join(kept.hint("merge"), DOC, "left_semi").select(*by_own_names(back))
