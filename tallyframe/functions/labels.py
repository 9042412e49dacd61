"""Class labels: the declared domain, and the index of the classes in use."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.catalog import NUM_CLASSES

def _nominal(size: int) -> dict:
    return {"ml_attr": {"type": "nominal", "num_vals": size}}


def with_label_domain(examples: DataFrame, num_classes: int = NUM_CLASSES) -> DataFrame:
    """Declare the labels as classes 0 .. num_classes-1.

    Without it every estimator runs an extra job to find the largest label,
    and sizes the model by what it saw rather than by what was declared.
    """
    return examples.withColumn(
        "label", F.col("label").alias("label", metadata=_nominal(num_classes))
    )


def with_class_index(examples: DataFrame, labels: Sequence[float], column: str) -> DataFrame:
    """Position of each label in ``labels``. A label not in the list fails the job."""
    position = F.array_position(F.lit(list(labels)), F.col("label"))
    unknown = F.raise_error(F.concat(F.lit("label not listed: "), F.col("label").cast("string")))
    index = F.when(position > 0, (position - 1).cast("double")).otherwise(unknown)
    return examples.withColumn(column, index.alias(column, metadata=_nominal(len(labels))))
