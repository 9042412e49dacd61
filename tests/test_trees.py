import math

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from conftest import SF_DIR
from checks import fixtures
from tallyframe import FOREST
from tallyframe.functions import majority_vote
from tallyframe.functions.trees import leaf_values, table_of, with_tree_values
from tallyframe.operators import fit
from tallyframe.operators.voting import VotingForest

HEAD = "DecisionTreeClassificationModel: uid=x, depth=0, numNodes=1, numClasses=2, numFeatures=1\n"


def by_models(frame, forest):
    """The vote of Spark's own trees, one call a tree."""
    votes = []
    for i, tree in enumerate(forest.trees):
        names = {"predictionCol": f"v{i}", "rawPredictionCol": "", "probabilityCol": ""}
        frame = tree.copy({tree.getParam(k): v for k, v in names.items()}).transform(frame)
        votes.append(f"v{i}")
    return majority_vote(frame, votes, "prediction", forest.numClasses)


@pytest.mark.parametrize("fixture", [fixtures.graded, fixtures.cells, fixtures.halves, fixtures.baseline])
def test_equal_to_the_trees_themselves(spark, fixture):
    frame = fixture(spark, SF_DIR)
    model = fit(frame, FOREST)
    ours, theirs = model.transform(frame), by_models(frame, model.forest)
    assert ours.columns == theirs.columns
    assert ours.exceptAll(theirs).count() == 0 and ours.count() == theirs.count()


def test_values_at_and_beside_thresholds(spark):
    rng = np.random.default_rng(3)
    rows = [(float(rng.integers(0, 4)), Vectors.dense(rng.normal(size=3).round(1))) for _ in range(500)]
    frame = spark.createDataFrame(rows, ["label", "features"])
    forest = RandomForestClassifier(numTrees=5, maxDepth=7, seed=1).fit(frame)
    table = table_of([tree.toDebugString for tree in forest.trees])
    cuts = sorted(set(zip(table.feature, table.threshold, strict=True)))
    odd = []
    for f, t in cuts:
        for value in (t, math.nextafter(t, math.inf), math.nan, math.inf, -math.inf, -0.0):
            x = [0.1, -0.3, 0.7]
            x[f] = value
            odd.append((Vectors.dense(x),))
    odd.append((Vectors.sparse(3, {1: 0.2}),))
    asked = spark.createDataFrame(odd, ["features"])
    ours = VotingForest(forest).transform(asked).select("prediction").collect()
    assert ours == by_models(asked, forest).select("prediction").collect()


def test_single_leaves_and_odd_descriptions(spark):
    table = table_of([HEAD + "  Predict: 3.0\n", HEAD + "  Predict: 1.0\n"])
    assert (table.depth, table.roots, table.value) == (0, [0, 1], [3.0, 1.0])
    frame = spark.createDataFrame([(1, [0.5]), (2, [])], "id int, x array<double>")
    found = with_tree_values(frame.filter("id = 1"), F.col("x"), 1, table, ["a", "b"]).collect()
    assert [tuple(r) for r in found] == [(1, [0.5], 3.0, 1.0)]
    split = HEAD + "  If (feature 0 <= 1.0)\n   Predict: 1.0\n  Else (feature 0 > 1.0)\n   Predict: 2.0\n"
    assert with_tree_values(frame, F.col("x"), 0, table_of([split]), ["a"]).first()["a"] == 1.0
    with pytest.raises(Exception, match="expected a vector of 1 features"):
        with_tree_values(frame, F.col("x"), 1, table_of([split]), ["a"]).collect()
    with pytest.raises(ValueError, match="another kind"):
        table_of([HEAD + "  If (feature 0 in {1.0})\n"])
    with pytest.raises(ValueError, match="other side"):
        table_of([HEAD + "  If (feature 0 <= 1.0)\n   Predict: 1.0\n  Predict: 2.0\n"])


def test_leaves_are_counted_from_left_to_right(spark):
    frame = fixtures.graded(spark, SF_DIR)
    forest = fit(frame, FOREST).forest
    tree = forest.trees[0]
    values = leaf_values([tree.toDebugString])[0]
    found = tree.copy({tree.leafCol: "leaf"}).transform(frame).select("leaf", "prediction").distinct()
    places = {int(row["leaf"]): row["prediction"] for row in found.collect()}
    assert len(places) > 4
    assert all(values[place] == prediction for place, prediction in places.items())
    assert leaf_values([HEAD + "  Predict: 3.0\n"]) == [[3.0]]


def test_short_and_missing_vectors_fail(spark):
    rng = np.random.default_rng(3)
    rows = [(float(i % 2), Vectors.dense([float(i % 2), *rng.normal(size=2)])) for i in range(50)]
    frame = spark.createDataFrame(rows, ["label", "features"])
    model = VotingForest(RandomForestClassifier(numTrees=3, maxDepth=1, seed=1).fit(frame))
    for short in (Vectors.dense([0.0, 1.0]), Vectors.sparse(2, {0: 1.0}), None):
        asked = spark.createDataFrame([(short,)], frame.select("features").schema)
        with pytest.raises(Exception):
            model.transform(asked).collect()
    longer = spark.createDataFrame([(Vectors.sparse(4, {0: 1.0}),)], ["features"])
    assert model.transform(longer).select("prediction").collect() == by_models(
        longer, model.forest
    ).select("prediction").collect()
