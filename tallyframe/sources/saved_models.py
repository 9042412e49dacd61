"""Models on disk, one directory per kind, in Spark's own model format."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import DecisionTreeClassificationModel, LogisticRegressionModel

from tallyframe.catalog import ALL_KINDS, BAYES, FOREST, LOGISTIC, TREE, ModelKind, kind_of
from tallyframe.operators.voting import VotingForest

_CLASSES = {
    LOGISTIC.key: LogisticRegressionModel,
    TREE.key: DecisionTreeClassificationModel,
    BAYES.key: PipelineModel,
    FOREST.key: VotingForest,
}


def save_model(model: Transformer, path: str, overwrite: bool = False) -> None:
    """Write one model. An existing path is an error unless ``overwrite`` is set."""
    writer = model.write()
    (writer.overwrite() if overwrite else writer).save(path)


def load_model(path: str, kind: ModelKind) -> Transformer:
    return _CLASSES[kind.key].load(path)


def model_path(directory: str, kind: ModelKind) -> str:
    return f"{directory.rstrip('/')}/{kind.directory}"


def save_models(
    models: Mapping[str, Transformer], directory: str, overwrite: bool = False
) -> None:
    for key, model in models.items():
        save_model(model, model_path(directory, kind_of(key)), overwrite)


def load_models(
    directory: str, kinds: Iterable[ModelKind] = ALL_KINDS
) -> dict[str, Transformer]:
    return {kind.key: load_model(model_path(directory, kind), kind) for kind in kinds}
