"""Conditions that the optimizer leaves where they stand."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def settled(condition: Column) -> Column:
    """A condition that is worked out once, as a column of its own.

    A filter on it is neither pushed below the columns it is made of, which would
    write their expressions out again inside the filter, nor pruned with them.
    """
    return condition & (F.monotonically_increasing_id() >= 0)
