"""Fitted trees as expressions over an array of features.

The nodes of several trees stand in one table, held as literal arrays. A leaf
is its own child, so that every row takes the same number of steps, and each
step moves all trees of a row down one level. The steps are projections without
a call into a model object. Their generated code grows with trees times levels;
the JVM compiles that of one tree, not that of a forest.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPLIT = re.compile(r"\s*If \(feature (\d+) <= (\S+)\)$")
_OTHERWISE = re.compile(r"\s*Else \(feature \d+ > \S+\)$")
_LEAF = re.compile(r"\s*Predict: (\S+)$")


@dataclass
class TreeTable:
    """The nodes of some trees. ``children`` holds two nodes each: at most the threshold, above it."""

    feature: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    children: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    roots: list[int] = field(default_factory=list)
    depth: int = 0

    def add(self, description: str) -> None:
        """Add a tree by its ``toDebugString``. Only splits at thresholds are known."""
        lines = iter(description.rstrip().splitlines()[1:])
        self.roots.append(self._node(lines, 0))

    def _node(self, lines: Iterator[str], level: int) -> int:
        line, at = next(lines), len(self.feature)
        leaf, split = _LEAF.match(line), _SPLIT.match(line)
        if not (leaf or split):
            raise ValueError(f"a tree with a node of another kind: {line.strip()!r}")
        self.feature.append(int(split[1]) if split else 0)
        self.threshold.append(float(split[2]) if split else 0.0)
        self.value.append(float(leaf[1]) if leaf else 0.0)
        self.children += [at, at]
        if split:
            self.children[2 * at] = self._node(lines, level + 1)
            if not _OTHERWISE.match(next(lines)):
                raise ValueError("a split without its other side")
            self.children[2 * at + 1] = self._node(lines, level + 1)
        self.depth = max(self.depth, level)
        return at


def table_of(descriptions: Sequence[str]) -> TreeTable:
    table = TreeTable()
    for description in descriptions:
        table.add(description)
    return table


def leaf_values(descriptions: Sequence[str]) -> list[list[float]]:
    """The values of each tree's leaves by ``toDebugString``, in the order in which ``leafCol`` counts them.

    That is from left to right: what is at most the threshold first.
    """
    tables = [table_of([description]) for description in descriptions]
    return [
        [t.value[at] for at in range(len(t.value)) if t.children[2 * at] == at] for t in tables
    ]


def with_tree_values(
    df: DataFrame, values: Column, num_features: int, table: TreeTable, out: Sequence[str]
) -> DataFrame:
    """Add one column a tree, the value of the leaf that ``values`` (an array) leads to.

    A value that is not a number is above every threshold, as in the models. An
    array of fewer than ``num_features`` values, or null, fails the job.
    """
    kept = [F.col(f"`{name}`") for name in df.columns]
    nodes = [f"__node_{i}" for i in range(len(out))]
    refused = F.raise_error(F.lit(f"expected a vector of {num_features} features"))
    whole = F.when(F.size(values) >= num_features, values).otherwise(refused)
    feature, children = (
        F.lit(np.array(x, np.int32)) for x in (table.feature, table.children)
    )
    threshold, leaf = (F.lit(np.array(x, np.float64)) for x in (table.threshold, table.value))

    def below(at: Column) -> Column:
        held = F.get(F.col("__values"), F.get(feature, at)) <= F.get(threshold, at)
        return F.get(children, 2 * at + F.when(held, 0).otherwise(1))

    now = df.select(*kept, whole.alias("__values"))
    places = [F.lit(root) for root in table.roots]
    for _ in range(table.depth):
        now = now.select(
            *kept, "__values", *[below(at).alias(n) for at, n in zip(places, nodes, strict=True)]
        )
        places = [F.col(n) for n in nodes]
    return now.select(*kept, *[F.get(leaf, at).alias(n) for at, n in zip(places, out, strict=True)])
