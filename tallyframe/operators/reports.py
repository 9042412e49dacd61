"""Reports: features, label and predictions side by side, all as text."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.catalog import ALL_KINDS, FEATURES_COLUMN, LABEL_COLUMN, ModelKind
from tallyframe.functions.text import cut_cell, double_text, required_text, vector_text


def _number(column: str, title: str) -> Column:
    value = F.col(column)
    return required_text(value, double_text(value), title).alias(title)


def _row(predictions: list[Column]) -> list[Column]:
    vector = F.col("features")
    features = required_text(vector, vector_text(vector), FEATURES_COLUMN)
    return [features.alias(FEATURES_COLUMN), _number("label", LABEL_COLUMN), *predictions]


def model_report(
    scored: DataFrame, kind: ModelKind, prediction: str = "prediction", training: bool = False
) -> DataFrame:
    """Three columns; the last is named as in a training or a prediction run."""
    title = kind.training_column if training else kind.prediction_column
    return scored.select(*_row([_number(prediction, title)]))


def plain_report(scored: DataFrame, prediction: str = "prediction") -> DataFrame:
    """The single-model report under the names ``features``, ``label``, ``prediction``."""
    columns = _row([_number(prediction, "prediction")])
    return scored.select(*columns).toDF("features", "label", "prediction")


def comparison_report(scored: DataFrame, kinds: Iterable[ModelKind] = ALL_KINDS) -> DataFrame:
    """A frame from ``score_all`` with one prediction column per model."""
    return scored.select(*_row([_number(k.score_column, k.prediction_column) for k in kinds]))


def preview(report: DataFrame, rows: int = 20, width: int = 20) -> DataFrame:
    """The first rows with cells cut to ``width``, as ``show()`` prints them."""
    return report.limit(rows).select(
        *[cut_cell(F.col(f"`{name}`"), width).alias(name) for name in report.columns]
    )


def write_report(report: DataFrame, path: str, overwrite: bool = False) -> None:
    """Write from the executors, one file per partition."""
    report.write.mode("overwrite" if overwrite else "errorifexists").parquet(path)
