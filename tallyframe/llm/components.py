"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import write_out


def _least(edges: DataFrame) -> DataFrame:
    """Each node's least neighbour or itself, reduced before it is shuffled."""
    return edges.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b): the least node it is connected to.

    Large and small stars take turns until nothing changes. Each step is an
    aggregate and a join, and is written to the shared folder.
    """
    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = write_out(now.filter("a <> b").distinct(), "edges")
    for _ in range(most_rounds):
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.join(_least(both), "a").filter("b > a").select(F.col("b").alias("a"), "m")
        large = write_out(large.filter("a <> m").distinct().withColumnRenamed("m", "b"), "stars")
        least = _least(large)
        joined = large.join(least, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", F.col("m").alias("b"))
        )
        small = write_out(small.filter("a <> b").distinct(), "stars")
        if _same(now, small):
            return small.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                small.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        now = small
    raise RuntimeError("the components did not settle")


def _same(one: DataFrame, two: DataFrame) -> bool:
    def mark(edges: DataFrame):
        pair = F.xxhash64("a", "b")
        return edges.agg(F.count("*"), F.bit_xor(pair), F.sum(F.pmod(pair, F.lit(2**31)))).first()

    return mark(one) == mark(two)
