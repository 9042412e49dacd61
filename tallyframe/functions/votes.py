"""Majority vote over class columns; the smallest class wins a tie."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.catalog import NUM_CLASSES


def _counted(tally: Column, num_classes: int, bits: int) -> Column:
    # Class c owns the bits from c * bits up. Votes first, then the smaller
    # class: one integer orders both. Shifts and masks only, which is less code
    # than checked arithmetic.
    low = (num_classes - 1).bit_length()
    last = (1 << low) - 1

    def ranked(c: int) -> Column:
        at, mask = c * bits - low, F.lit(((1 << bits) - 1) << low).cast("bigint")
        moved = F.shiftright(tally, at) if at > 0 else F.shiftleft(tally, -at)
        return moved.bitwiseAND(mask).bitwiseOR(F.lit(last - c).cast("bigint"))

    ranks = [ranked(c) for c in range(num_classes)]
    best = F.greatest(*ranks) if num_classes > 1 else ranks[0]
    return (last - best.bitwiseAND(F.lit(last).cast("bigint"))).cast("double")


def _listed(votes: Column) -> Column:
    ranked = F.transform(
        F.array_distinct(votes),
        lambda c: F.struct(F.size(F.filter(votes, lambda v: v == c)).alias("n"), (-c).alias("c")),
    )
    return (-F.array_max(ranked)["c"]).cast("double")


def _legal(votes: Sequence[Column], num_classes: int) -> Column:
    """Whether all votes are classes; null if one is null."""
    low, high = (F.least(*votes), F.greatest(*votes)) if len(votes) > 1 else (votes[0], votes[0])
    # No vote is below zero, so the fractions cannot cancel each other.
    whole = reduce(add, [v.cast("int") for v in votes]) == reduce(add, votes)
    return whole & (low >= 0) & (high < num_classes)


def majority_vote(
    df: DataFrame,
    votes: Sequence[str],
    out: str,
    num_classes: int = NUM_CLASSES,
    trusted: bool = False,
) -> DataFrame:
    """Replace the vote columns, holding 0 .. num_classes-1, by the winner ``out``.

    Any other vote, null too, fails the job, unless the votes are ``trusted``
    because a model of so many classes has made them.

    The votes per class are kept as digits of one BIGINT, which is integer
    arithmetic in generated code. Ensembles too wide for that take the same
    vote over an array, with interpreted lambdas.
    """
    kept = [F.col(f"`{name}`") for name in df.columns if name not in votes]
    cast = [F.col(f"`{name}`") for name in votes]
    refused = F.raise_error(F.lit(f"a vote is none of the classes 0 to {num_classes - 1}"))

    def checked(winner: Column) -> Column:
        return winner if trusted else F.when(_legal(cast, num_classes), winner).otherwise(refused)

    bits = len(votes).bit_length()
    if bits * num_classes > 63:
        listed = df.select(*kept, checked(F.array(*cast)).alias("__votes"))
        return listed.select(*kept, _listed(F.col("__votes")).alias(out))
    one = F.lit(1).cast("bigint")
    digits = [F.call_function("shiftleft", one, v.cast("int") * bits) for v in cast]
    tallied = df.select(*kept, checked(reduce(add, digits)).alias("__tally"))
    return tallied.select(*kept, _counted(F.col("__tally"), num_classes, bits).alias(out))
