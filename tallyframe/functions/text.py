"""Text forms of vectors, numbers and report cells."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F


def double_text(value: Column) -> Column:
    return value.cast("double").cast("string")


def vector_text(vector: Column) -> Column:
    """``[v1,v2,...]`` with no blanks."""
    values = vector_to_array(vector).cast("array<string>")
    return F.concat(F.lit("["), F.concat_ws(",", values), F.lit("]"))


def required_text(value: Column, text: Column, name: str) -> Column:
    """``text``, made from ``value``, as a non-nullable column; a null fails the job."""
    missing = F.raise_error(F.lit(f"null in {name}"))
    return F.coalesce(F.when(value.isNotNull(), text).otherwise(missing), F.lit(""))


def cut_cell(text: Column, width: int = 20) -> Column:
    """A cell as ``show()`` prints it: longer text ends in three dots at ``width``.

    ``text`` stands in it once, so that the optimizer can write it into what makes
    the cells; then the first rows of a sorted frame are found without sorting all.
    """
    kept = max(width - 3, 0)
    longer = rf"(?s)\A(.{{{kept}}}).{{{width + 1 - kept},}}\z"
    return F.regexp_replace(text, longer, "$1...")
