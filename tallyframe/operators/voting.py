"""A random forest in which every tree has one vote."""

from __future__ import annotations

import numpy as np
from pyspark.ml import Transformer
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.util import MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.trees import leaf_values
from tallyframe.functions.votes import majority_vote

_LEAVES = "__leaves"


def _size(vector: Column) -> Column:
    held = F.unwrap_udt(vector)
    return F.coalesce(held["size"], F.size(held["values"]))


class VotingForest(Transformer):
    """Adds ``prediction``, the majority of the trees' predictions.

    Spark's own forest adds up class probabilities, which gives another answer
    on close calls. One call of it a row tells the leaf that the row ends in, for
    all trees; the classes of the leaves and the vote are expressions. Whole trees
    as expressions are more code than the JVM compiles. The saved form is that of
    the wrapped Spark forest.
    """

    def __init__(self, forest: RandomForestClassificationModel) -> None:
        super().__init__()
        self.forest = forest
        self._leaves = leaf_values([tree.toDebugString for tree in forest.trees])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        forest = self.forest
        kept = [F.col(f"`{name}`") for name in dataset.columns]
        # Its own prediction is not selected below, so it is never made.
        names = {"predictionCol": "__own", "rawPredictionCol": "", "probabilityCol": "", "leafCol": _LEAVES}
        found = forest.copy({forest.getParam(k): v for k, v in names.items()}).transform(dataset)
        # A vector that is too short fails the job even if no tree asks for what it lacks.
        refused = F.raise_error(F.lit(f"expected a vector of {forest.numFeatures} features"))
        whole = _size(F.col(f"`{forest.getFeaturesCol()}`")) >= forest.numFeatures
        places = F.when(whole, F.unwrap_udt(F.col(_LEAVES))["values"]).otherwise(refused)
        places = places.cast("array<int>")
        found = found.select(*kept, places.alias(_LEAVES))
        votes = {
            f"__vote_{i}": F.get(F.lit(np.array(values, np.int32)), F.get(F.col(_LEAVES), F.lit(i)))
            for i, values in enumerate(self._leaves)
        }
        voted = found.select(*kept, *[value.alias(name) for name, value in votes.items()])
        return majority_vote(voted, list(votes), "prediction", forest.numClasses, trusted=True)

    def write(self) -> MLWriter:
        return self.forest.write()

    @classmethod
    def load(cls, path: str) -> VotingForest:
        return cls(RandomForestClassificationModel.load(path))
