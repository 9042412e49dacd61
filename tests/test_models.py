import math

import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from checks import fixtures
from conftest import SF_DIR
from tallyframe import ALL_KINDS, BAYES, FOREST, LOGISTIC, TREE, kind_of
from tallyframe.functions import with_class_index, with_label_domain
from tallyframe.operators import training
from tallyframe.operators import (
    accuracy,
    accuracy_metrics,
    fit,
    fit_all,
    fit_bayes,
    prediction_pairs,
    score,
    score_all,
)
from tallyframe.sources import load_model, load_models, save_model, save_models


@pytest.fixture(scope="module")
def examples(spark):
    frame = fixtures.cells(spark, SF_DIR).cache()
    yield frame
    frame.unpersist()


@pytest.fixture(scope="module")
def models(examples):
    return fit_all(examples, parallelism=4)


def test_shapes(models):
    logistic, tree, forest = (models[k.key] for k in (LOGISTIC, TREE, FOREST))
    assert (logistic.numClasses, logistic.numFeatures) == (10, 6)
    assert logistic.coefficientMatrix.toArray().shape == (10, 6)
    assert tree.numClasses == 10 and tree.depth <= 5
    assert forest.forest.getNumTrees == 9
    assert forest.forest.treeWeights == [1.0] * 9
    assert models[BAYES.key].stages[0].pi.size == 6


def test_scoring_adds_exactly_the_prediction_columns(examples, models):
    scored = score_all(examples, models)
    assert scored.columns == examples.columns + [k.score_column for k in ALL_KINDS]
    for kind in ALL_KINDS:
        assert score(examples, models[kind.key]).columns == examples.columns + ["prediction"]
    assert prediction_pairs(examples, models["tree"]).columns == ["prediction", "label"]


def test_one_at_a_time_gives_the_same_models(examples, models):
    alone = {kind.key: fit(examples, kind) for kind in ALL_KINDS}
    columns = [k.score_column for k in ALL_KINDS]
    together = score_all(examples, models).groupBy(*columns).count()
    separate = score_all(examples, alone).groupBy(*columns).count()
    assert sorted(together.collect()) == sorted(separate.collect())


@pytest.mark.parametrize("kind", ALL_KINDS, ids=lambda k: k.key)
def test_round_trip(kind, examples, models, tmp_path):
    path = str(tmp_path / "model")
    save_model(models[kind.key], path)
    with pytest.raises(Exception, match="already exists"):
        save_model(models[kind.key], path)
    save_model(models[kind.key], path, overwrite=True)
    before = score(examples, models[kind.key], "before").select(*fixtures.KEYS, "before")
    again = score(examples, load_model(path, kind), "before").select(*fixtures.KEYS, "before")
    assert before.exceptAll(again).count() == 0 and again.exceptAll(before).count() == 0


def test_directory_layout(models, tmp_path):
    save_models(models, str(tmp_path))
    assert sorted(p.name for p in tmp_path.iterdir()) == [
        "decisionTreeModel",
        "logisticRegressionModel",
        "naiveBayesModel",
        "randomForestModel",
    ]
    assert list(load_models(str(tmp_path), [TREE, BAYES])) == ["tree", "bayes"]


def test_labels_that_are_new_at_scoring_count_as_wrong(examples, models):
    renamed = examples.withColumn("label", F.lit(0.0))
    for kind in ALL_KINDS:
        scored = score(renamed, models[kind.key])
        assert accuracy(scored).first()["accuracy"] == 0.0


def test_unlabelled_rows_can_be_scored(examples, models):
    scored = score_all(examples.select("features"), models)
    assert scored.filter(F.col("bayes_prediction").isNull()).count() == 0


def test_bayes_takes_any_label_values_in_numeric_order(spark, examples):
    shifted = examples.withColumn("label", F.when(F.col("label") == 3, 10.5).otherwise(F.col("label")))
    for labels in (None, [4, 5, 6, 7, 8, 10.5]):
        predicted = score(shifted, fit_bayes(shifted, labels)).select("prediction").distinct()
        assert {r["prediction"] for r in predicted.collect()} == {4.0, 5.0, 6.0, 7.0, 8.0, 10.5}
    with pytest.raises(ValueError, match="not listed"):
        fit_bayes(shifted, [4, 5])


def test_bayes_makes_one_pass_and_equals_the_estimator(spark, examples, tmp_path):
    from pyspark.ml.classification import NaiveBayes

    # What an input is read for is counted by the rows that pass it.
    passed = spark.sparkContext.accumulator(0)
    text = str(tmp_path / "rows")
    examples.write.parquet(text)
    read = spark.read.parquet(text)

    def count(batches):
        for batch in batches:
            passed.add(len(batch))
            yield batch

    values = read.select("label", vector_to_array("features").alias("x"))
    watched = values.mapInPandas(count, values.schema).select(
        "label", array_to_vector("x").alias("features")
    )
    ours = fit_bayes(watched).stages[0]
    assert passed.value == examples.count()
    theirs = NaiveBayes(modelType="multinomial", smoothing=1.0).fit(read)
    seen = [3.0, 4.0, 5.0, 6.0, 7.0, 8.0]
    assert (ours.pi.toArray() == theirs.pi.toArray()).all() and ours.numClasses == len(seen)
    assert (ours.theta.toArray() == theirs.theta.toArray()).all()


def test_bayes_of_odd_examples(spark, examples):
    with pytest.raises(ValueError, match="no examples"):
        fit_bayes(examples.limit(0))
    with pytest.raises(ValueError, match="null or not a number"):
        fit_bayes(examples.withColumn("label", F.when(F.col("label") > 3, F.col("label"))))
    one = fit_bayes(examples.limit(1))
    assert score(examples, one).select("prediction").distinct().count() == 1


def test_one_failed_fit_starts_no_other(spark, examples, monkeypatch):
    begun = []

    def failing(frame, **options):
        begun.append("logistic")
        raise ValueError("no fit")

    monkeypatch.setitem(training._FITS, "logistic", failing)
    monkeypatch.setitem(training._FITS, "tree", lambda frame: begun.append("tree"))
    with pytest.raises(ValueError, match="no fit"):
        fit_all(examples, [LOGISTIC, TREE])
    assert begun == ["logistic"]


def test_bayes_refuses_negative_features(spark):
    from pyspark.ml.linalg import Vectors

    frame = spark.createDataFrame([(0.0, Vectors.dense(-1.0)), (1.0, Vectors.dense(1.0))])
    with pytest.raises(Exception, match="(?i)nonnegative|non-negative|negative"):
        fit_bayes(frame.toDF("label", "features"))


def test_a_label_outside_the_declared_classes_is_refused(spark, examples):
    with pytest.raises(Exception, match="(?i)label"):
        fit(examples.withColumn("label", F.lit(10.0)), TREE)


def test_class_index_rejects_unlisted_labels(examples):
    with pytest.raises(Exception, match="label not listed"):
        with_class_index(examples, [3.0, 4.0], "index").select("index").collect()


def test_label_domain_only_adds_metadata(examples):
    declared = with_label_domain(examples)
    assert declared.columns == examples.columns
    assert declared.schema["label"].metadata["ml_attr"]["num_vals"] == 10


def test_evaluator_gives_the_same_accuracy(examples, models):
    scored = score(examples, models["bayes"])
    assert math.isclose(accuracy_metrics(scored), accuracy(scored).first()["accuracy"])


def test_unknown_model_name():
    with pytest.raises(ValueError, match="unknown model"):
        kind_of("other")
