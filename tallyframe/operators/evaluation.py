"""Comparing predictions with labels.

Each measure is one aggregate: partial results per task, one row at the end.
A frame without rows gives NaN, as zero divided by zero does. A null prediction
or label fails the job, so that no row can drop out of a measure.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.catalog import ALL_KINDS, ModelKind


def _correct(prediction: str, label: str) -> Column:
    held = F.col(prediction).isNotNull() & F.col(label).isNotNull()
    return F.when(held, F.col(prediction) == F.col(label)).otherwise(
        F.raise_error(F.lit(f"null in {prediction} or {label}"))
    )


def _share(condition: Column) -> Column:
    return F.coalesce(F.avg(condition.cast("double")), F.lit(float("nan")))


def accuracy_of(prediction: str, label: str = "label") -> Column:
    """The accuracy as an aggregate column, to be used with other aggregates."""
    return _share(_correct(prediction, label))


def correct_rows(
    scored: DataFrame, prediction: str = "prediction", label: str = "label"
) -> DataFrame:
    return scored.filter(_correct(prediction, label))


def wrong_rows(
    scored: DataFrame, prediction: str = "prediction", label: str = "label"
) -> DataFrame:
    return scored.filter(~_correct(prediction, label))


def accuracy(
    scored: DataFrame, prediction: str = "prediction", label: str = "label"
) -> DataFrame:
    return scored.agg(accuracy_of(prediction, label).alias("accuracy"))


def error_rate(
    scored: DataFrame, prediction: str = "prediction", label: str = "label"
) -> DataFrame:
    return scored.agg(_share(~_correct(prediction, label)).alias("error_rate"))


def accuracy_metrics(
    scored: DataFrame, prediction: str = "prediction", label: str = "label"
) -> float:
    """The same number through Spark's multi-class evaluator."""
    evaluator = MulticlassClassificationEvaluator(
        predictionCol=prediction, labelCol=label, metricName="accuracy"
    )
    return evaluator.evaluate(scored)


def accuracy_summary(scored: DataFrame, kinds: Iterable[ModelKind] = ALL_KINDS) -> DataFrame:
    """(``model``, ``accuracy``) for a frame from ``score_all``, in one pass."""
    kinds = list(kinds)
    wide = scored.agg(*[accuracy_of(k.score_column).alias(k.title) for k in kinds])
    return wide.unpivot([], [k.title for k in kinds], "model", "accuracy")


def accuracy_lines(summary: DataFrame, dataset: str | None = None) -> DataFrame:
    """One ``line`` per model: ``Accuracy = 0.5 (Decision Tree)``."""
    where = "" if dataset is None else f" on {dataset}"
    return summary.select(
        F.concat(
            F.lit("Accuracy = "),
            F.col("accuracy").cast("string"),
            F.lit(" ("),
            F.col("model"),
            F.lit(f"{where})"),
        ).alias("line")
    )
