"""Multi-class classification over delimited text, as Spark DataFrame plans."""

from tallyframe.catalog import ALL_KINDS, BAYES, FOREST, LOGISTIC, TREE, ModelKind, kind_of

__all__ = ["ALL_KINDS", "BAYES", "FOREST", "LOGISTIC", "TREE", "ModelKind", "kind_of"]
