"""The DataFrame models against Spark's RDD-based ones on sparse labels 3 .. 8."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.classification import LogisticRegressionWithLBFGS, NaiveBayes
from pyspark.mllib.linalg import Vectors
from pyspark.mllib.regression import LabeledPoint
from pyspark.mllib.tree import DecisionTree, RandomForest
from pyspark.sql import functions as F

from tallyframe import BAYES, FOREST, LOGISTIC, TREE
from tallyframe.operators import fit, score

WIDTH = 11


@pytest.fixture(scope="module", params=[1, 3], ids=["one partition", "three partitions"])
def data(spark, request):
    rng = np.random.default_rng(42)
    features = rng.gamma(2.0, 2.0, size=(1200, WIDTH)).round(3)
    signal = features[:, 0] + 0.7 * features[:, 3] - 0.4 * features[:, 8]
    noise = rng.normal(0, 0.8, size=1200)
    cuts = np.quantile(signal, [0.05, 0.2, 0.55, 0.85, 0.97])
    labels = 3.0 + np.searchsorted(cuts, signal + noise)
    rows = [(i, float(y), x.tolist()) for i, (x, y) in enumerate(zip(features, labels))]
    frame = (
        spark.createDataFrame(rows, "id int, label double, x array<double>")
        .repartitionByRange(request.param, "id")
        .sortWithinPartitions("id")
        .select("id", "label", array_to_vector(F.col("x")).alias("features"))
        .cache()
    )
    points = frame.rdd.map(lambda r: LabeledPoint(r.label, Vectors.dense(r.features.toArray())))
    points.cache()
    yield frame, points
    points.unpersist()
    frame.unpersist()


def agreement(data, kind, model):
    frame, points = data
    ours = score(frame, fit(frame, kind)).orderBy("id").select("prediction").collect()
    theirs = model.predict(points.map(lambda p: p.features)).collect()
    return float(np.mean([row["prediction"] == value for row, value in zip(ours, theirs)]))


def test_tree(data):
    model = DecisionTree.trainClassifier(data[1], 10, {}, "gini", 5, 32)
    assert agreement(data, TREE, model) == 1.0
    assert fit(data[0], TREE).numNodes == model.numNodes()


def test_forest_votes(data):
    model = RandomForest.trainClassifier(data[1], 10, {}, 9, "auto", "gini", 5, 32, 12345)
    assert agreement(data, FOREST, model) == 1.0


def test_bayes(data):
    model = NaiveBayes.train(data[1], 1.0)
    ours = fit(data[0], BAYES).stages[0]
    assert np.allclose(ours.pi.toArray(), model.pi)
    assert np.allclose(ours.theta.toArray(), np.array(model.theta))
    assert agreement(data, BAYES, model) == 1.0


def test_logistic(data):
    model = LogisticRegressionWithLBFGS.train(data[1], numClasses=10)
    assert agreement(data, LOGISTIC, model) >= 0.99
    ours = fit(data[0], LOGISTIC)
    assert (ours.numClasses, ours.numFeatures) == (10, WIDTH)
    assert not ours.interceptVector.toArray().any()
