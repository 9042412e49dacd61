"""Scoring: models add prediction columns; rows never leave the executors."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import Transformer
from pyspark.sql import DataFrame

from tallyframe.catalog import ALL_KINDS


def score(df: DataFrame, model: Transformer, out: str = "prediction") -> DataFrame:
    """Add the predicted label as ``out``, keeping the other columns."""
    scored = model.transform(df)
    return scored if out == "prediction" else scored.withColumnRenamed("prediction", out)


def score_all(df: DataFrame, models: Mapping[str, Transformer]) -> DataFrame:
    """Add one prediction column per model, all in one narrow plan."""
    for kind in ALL_KINDS:
        if kind.key in models:
            df = score(df, models[kind.key], kind.score_column)
    return df


def prediction_pairs(df: DataFrame, model: Transformer) -> DataFrame:
    """(``prediction``, ``label``) for every row."""
    return score(df, model).select("prediction", "label")
