"""Line dedup over levelled sorted runs of line hashes.

The lines seen so far are kept as runs: tables of (hash, owner), bucketed by the
hash and sorted in each bucket. A batch of documents is reduced to its distinct
hashes, merge-anti-joined with every run, and what is new becomes a run of level
0. When a level holds ``fanout`` runs they are merged into one of the next
level, so that a batch meets logarithmically many runs. Batches are ranges of
ascending ids, so a hash found in a run is owned by a smaller id.

Hashes are 128 bits wide. They are reduced to one row for each hash before they
move, so a line that a third of all documents hold is no hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm.common import (
    BLANKS,
    ascii_lower,
    by_own_names,
    id_of,
    set_apart,
    unique_name,
    whole_text,
    write_out,
)
from tallyframe.storage import new_shared_path

MIN_CHARS = 10
BATCHES = 4
FANOUT = 2
HASH = ["_h1", "_h2"]
#: Positions belong to a text of an id: rows may share an id, and those without one all do.
TEXT = ["_id", "_k"]


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


class LineRuns:
    """Runs of line hashes by level; state of an ingest that goes on and on.

    Runs that a compaction has merged stay on storage until ``drop``, since
    frames made from them are lazy.
    """

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark = spark
        self.fanout = fanout
        self.levels: list[list[str]] = [[]]
        self.names: list[str] = []

    def _write(self, rows: DataFrame) -> str:
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        name = unique_name("line_run")
        (
            rows.repartition(buckets, *HASH)
            .write.bucketBy(buckets, *HASH)
            .sortBy(*HASH)
            .option("path", new_shared_path(self.spark, name))
            .saveAsTable(name)
        )
        self.names.append(name)
        return name

    def new_of(self, keys: DataFrame) -> DataFrame:
        """The rows of ``keys`` whose hash is in no run."""
        for run in (run for level in self.levels for run in level):
            keys = keys.join(self.spark.table(run).hint("merge"), HASH, "left_anti")
        return keys

    def add(self, keys: DataFrame) -> DataFrame:
        """Add the new rows of ``keys`` (one row a hash) as a run; returns that run."""
        fresh = self._write(self.new_of(keys))
        self.levels[0].append(fresh)
        for depth, level in enumerate(self.levels):
            if len(level) >= self.fanout:
                tables = [self.spark.table(run) for run in level]
                merged = tables[0]
                for table in tables[1:]:
                    merged = merged.union(table)
                if depth + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[depth + 1].append(self._write(merged))
                level.clear()
        return self.spark.table(fresh)

    def drop(self) -> None:
        """Forget the tables; their files stay in the shared folder."""
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def _keyed(docs: DataFrame, *columns: str) -> DataFrame:
    """``columns`` with the id and the text's hash."""
    return docs.select(*columns, id_of().alias("_id"), F.xxhash64(whole_text()).alias("_k"))


def _bounds(docs: DataFrame, batches: int) -> list[int]:
    """Ids that cut the documents into batches of about equal size."""
    cuts = [i / batches for i in range(1, batches)]
    row = docs.agg(F.percentile_approx("_id", cuts, 1_000).alias("cuts")).first()
    return sorted(set(row["cuts"] or []))


def _lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """Position and hash of every line whose key is long enough."""
    lines = docs.select(*TEXT, F.posexplode(F.split(whole_text(), "\n")).alias("_at", "_line"))
    keyed = lines.select(*TEXT, "_at", line_key(F.col("_line")).alias("_key"))
    return keyed.filter(F.length("_key") >= min_chars).select(
        *TEXT,
        "_at",
        F.xxhash64("_key").alias("_h1"),
        F.xxhash64(F.lit("second"), "_key").alias("_h2"),
    )


def _without(lines: Column, dropped: Column) -> Column:
    """The lines outside the sorted positions: the gaps between them, joined."""
    ends = F.concat(dropped, F.array(F.size(lines)))
    gaps = F.transform(
        ends,
        lambda end, i: F.slice(
            lines,
            F.coalesce(F.get(dropped, i - 1), F.lit(-1)) + 2,
            end - F.coalesce(F.get(dropped, i - 1), F.lit(-1)) - 1,
        ),
    )
    return F.flatten(gaps)


def dropped_lines(
    docs: DataFrame,
    min_chars: int = MIN_CHARS,
    batches: int = BATCHES,
    fanout: int = FANOUT,
) -> DataFrame:
    """(_id, _k, _dropped): the sorted positions of the lines that go, where any do."""
    spark = docs.sparkSession
    docs = _keyed(docs, "text")
    runs, parts = LineRuns(spark, fanout), []
    low = None
    for high in [*_bounds(docs, batches), None]:
        batch = docs
        if low is not None:
            batch = batch.filter(F.col("_id") > low)
        if high is not None:
            batch = batch.filter(F.col("_id") <= high)
        lines = _lines(batch, min_chars)
        fresh = runs.add(lines.groupBy(*HASH).agg(F.min("_id").alias("_id")))
        gone = lines.join(fresh, ["_id", *HASH], "left_anti")
        # A text that comes twice under its id has each position twice.
        positions = gone.groupBy(*TEXT).agg(F.sort_array(F.collect_set("_at")).alias("_dropped"))
        parts.append(write_out(positions, "dropped-lines"))
        low = high
    runs.drop()
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.union(part)
    return whole


def dedup_lines(docs: DataFrame, **options: int) -> DataFrame:
    """``docs`` with ``n_lines``, ``n_dropped`` and ``kept_text``.

    Of a line key found in two documents, only the lines of the smallest
    ``doc_id`` stay; short lines always do. A null text counts as one empty
    line. Rows without an id count as one document after all others, and rows
    of one id as one document: they keep what they share, and each loses the
    lines of smaller ids from its own text. Columns of the new names are replaced.
    """
    docs, back = set_apart(docs, ["doc_id", "text"], ["n_lines", "n_dropped", "kept_text"])
    # Which lines go may be much or little; texts are always dealt by id, at any size.
    dropped = dropped_lines(docs.select("doc_id", "text"), **options)
    here = _keyed(docs, *docs.columns)
    joined = here.join(dropped.hint("merge"), TEXT, "left").withColumn("_lines", F.split(whole_text(), "\n"))
    none = F.col("_dropped").isNull()
    kept = F.array_join(_without(F.col("_lines"), F.col("_dropped")), "\n")
    made = joined.select(
        *docs.columns,
        F.size("_lines").cast("long").alias("n_lines"),
        F.when(none, 0).otherwise(F.size("_dropped")).cast("long").alias("n_dropped"),
        F.when(none, whole_text()).otherwise(kept).alias("kept_text"),
    )
    return made.select(*by_own_names(back), "n_lines", "n_dropped", "kept_text")
