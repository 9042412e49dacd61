"""The queries on eleven features: how their models are fitted and checked."""

import threading

import numpy as np
from pyspark.sql import functions as F

from checks import fixtures, registry
from conftest import SF_DIR
from tallyframe import ALL_KINDS
from tallyframe.operators import training


def test_logistic_regression_is_fitted_beside_the_others(spark, monkeypatch):
    both, kept = threading.Barrier(2, timeout=20), []

    def together(key):
        def fit(examples, **options):
            if key in ("logistic", "tree"):
                both.wait()  # breaks if the other does not begin before this one ends
            kept.append(key)

        return fit

    for kind in ALL_KINDS:
        monkeypatch.setitem(training._FITS, kind.key, together(kind.key))
    monkeypatch.setattr(registry, "score_all", lambda examples, models: sorted(models))
    models, scored = registry._eleven(spark, SF_DIR)
    assert sorted(kept) == scored == sorted(k.key for k in ALL_KINDS)


def test_the_class_of_most_by_hand(spark):
    rng = np.random.default_rng(11)
    x = rng.integers(0, 4, size=(5000, 3)).astype(float)
    weights = np.array([[0.5, -1.0, 0.25], [0.5, -1.0, 0.25], [-0.5, 1.0, 0.0], [0.0, 0.0, 0.0]])
    starts, named = np.array([0.0, 0.0, 0.5, 1.0]), [3.0, 4.0, 6.0, 8.0]
    scores = x @ weights.T + starts  # sums of quarters, so in any order the same
    wanted = [named[i] for i in scores.argmax(axis=1)]
    frame = spark.createDataFrame(
        [(i, row) for i, row in enumerate(x.tolist())], "id int, x array<double>"
    ).repartition(7, "id")
    found = frame.select("id", registry._greatest(F.col("x"), weights, starts, named).alias("most"))
    assert [r["most"] for r in found.orderBy("id").collect()] == wanted
    assert 4.0 not in wanted and {3.0, 6.0, 8.0} == set(wanted)
    nothing = found.filter(F.col("id") < 0)
    assert nothing.count() == 0 and "ArrowEvalPython" in found._jdf.queryExecution().toString()


def test_all_rows_are_checked_and_no_model_is_another(spark):
    rows = registry.eleven_features_checked(spark, SF_DIR).collect()
    n = fixtures.lineitem(spark, SF_DIR).count()
    assert [tuple(r) for r in rows] == [(k.title, n, n, 0) for k in ALL_KINDS]
