"""The search for the optimum of logistic regression, against Spark's own estimator."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from checks import fixtures
from conftest import SF_DIR
from tallyframe import LOGISTIC
from tallyframe.functions import with_label_domain
from tallyframe.operators import fit, logistic, score


@pytest.fixture(scope="module")
def eleven(spark):
    frame = fixtures.eleven(spark, SF_DIR).select("label", "features").cache()
    yield frame
    frame.unpersist()


def estimated(examples):
    estimator = LogisticRegression(family="multinomial", fitIntercept=False, regParam=0.0, maxIter=100, tol=1e-6)
    return estimator.fit(with_label_domain(examples))


def test_the_loss_is_no_more_than_the_estimators_in_fewer_steps(eleven):
    theirs, ours = estimated(eleven), fit(eleven, LOGISTIC)
    assert ours.losses[0] == pytest.approx(np.log(10))
    assert ours.losses[-1] <= theirs.summary.objectiveHistory[-1] + 1e-9
    assert all(later <= before for before, later in zip(ours.losses, ours.losses[1:]))
    assert len(ours.losses) - 1 < 0.75 * theirs.summary.totalIterations
    named = theirs.setRawPredictionCol("").setProbabilityCol("").setPredictionCol("theirs")
    both = named.transform(score(eleven, ours))
    assert both.filter(F.col("prediction") == F.col("theirs")).count() >= 0.99 * eleven.count()


def test_one_pass_over_the_examples(spark, eleven, tmp_path):
    eleven.write.parquet(str(tmp_path / "rows"))
    read = spark.read.parquet(str(tmp_path / "rows"))
    passed = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            passed.add(len(batch))
            yield batch

    values = read.select("label", vector_to_array("features").alias("x"))
    watched = values.mapInPandas(count, values.schema).select("label", array_to_vector("x").alias("features"))
    fit(watched, LOGISTIC, iterations=5)
    assert passed.value == read.count()


def test_the_model_holds_the_weights_as_they_were_found(eleven, tmp_path):
    found = logistic.optimum(eleven, 10, 4, 1e-6)
    model = fit(eleven, LOGISTIC, iterations=4)
    assert (model.coefficientMatrix.toArray() == found.weights).all() and len(found.losses) == 5
    assert np.abs(found.weights.sum(axis=0)).max() < 1e-12
    assert model.getMaxIter() == 4 and not model.isSet("upperBoundsOnCoefficients")


def test_columns_of_any_values_are_packed_without_loss():
    rng = np.random.default_rng(7)
    x = np.column_stack(
        [rng.integers(-5, 5, 3000), rng.integers(0, 30000, 3000), rng.normal(size=3000), rng.integers(0, 9, 3000) / 8]
        + [rng.normal(size=3000) * 1e300, rng.integers(0, 2**53, 3000)]
    ).astype(float)
    labels = rng.integers(0, 10, 3000).astype(float)
    rows = pa.array(x.tolist(), pa.list_(pa.float64()))
    batch = pa.RecordBatch.from_arrays([pa.array(labels), rows], ["label", "x"])
    packed = list(logistic._pack(10)([batch.slice(0, 1000), batch.slice(1000)]))
    assert [b.column("kinds")[0].as_py() for b in packed] == ["i1,i1,i2,f8,f4,f8,f8"] * 2
    back = list(logistic._unpacked(packed))
    assert (np.concatenate([a for a, _ in back]) == labels).all()
    assert (np.concatenate([b for _, b in back], axis=1) == x.T).all()


def test_features_of_one_value_or_that_depend_on_others_or_sparse(spark):
    rng = np.random.default_rng(3)
    a, noise = rng.integers(0, 6, 900).astype(float), rng.normal(0, 1.5, 900)
    rows = []
    for i, (value, off) in enumerate(zip(a.tolist(), noise.tolist())):
        features = [value, 5 - value, 5.0, 2 * value, 0.0, float(i % 3)]
        some = {j: v for j, v in enumerate(features) if v}
        rows.append((float(value + off > 2.5), Vectors.sparse(6, some) if i % 2 else Vectors.dense(features)))
    frame = spark.createDataFrame(rows, ["label", "features"])
    ours, theirs = fit(frame, LOGISTIC), estimated(frame)
    weights = ours.coefficientMatrix.toArray()
    assert not weights[:, [2, 4]].any() and not theirs.coefficientMatrix.toArray()[:, [2, 4]].any()
    assert ours.losses[-1] <= theirs.summary.objectiveHistory[-1] + 1e-6
    found = score(frame, ours).select("prediction").collect()
    assert found == theirs.transform(frame).select("prediction").collect()


def test_examples_that_no_weights_fit(spark, eleven):
    with pytest.raises(ValueError, match="no examples"):
        fit(eleven.limit(0), LOGISTIC)
    for label in (10.0, -1.0, 2.5, float("nan"), None):
        with pytest.raises(Exception, match="label"):
            fit(eleven.withColumn("label", F.lit(label).cast("double")), LOGISTIC)
    for odd in ([1.0, float("nan")], [1.0, float("inf")], [1.0]):
        rows = [(0.0, Vectors.dense([1.0, 2.0])), (1.0, Vectors.dense(odd))]
        with pytest.raises(Exception, match="feature"):
            fit(spark.createDataFrame(rows, ["label", "features"]), LOGISTIC)
