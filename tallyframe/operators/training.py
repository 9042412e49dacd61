"""Training: (``label``, ``features``) in, a model out.

Every model adds one column ``prediction`` that holds a label value, and is
saved in Spark's own format.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    DecisionTreeClassifier,
    LogisticRegression,
    LogisticRegressionModel,
    NaiveBayes,
    NaiveBayesModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.linalg import DenseMatrix, Vectors, VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tallyframe.catalog import (
    ALL_KINDS,
    BAYES,
    BAYES_SMOOTHING,
    FOREST,
    FOREST_SEED,
    FOREST_SUBSET,
    FOREST_TREES,
    LOGISTIC,
    LOGISTIC_ITERATIONS,
    LOGISTIC_TOLERANCE,
    NUM_CLASSES,
    TREE,
    TREE_BINS,
    TREE_DEPTH,
    TREE_IMPURITY,
    TREE_SEED,
    ModelKind,
)
from tallyframe.functions.labels import with_label_domain
from tallyframe.operators.logistic import optimum
from tallyframe.operators.voting import VotingForest

# Only the class is asked for, so scoring makes one call per row and model.
_CLASS_ONLY = {"rawPredictionCol": "", "probabilityCol": ""}


def bounded_partitions(examples: DataFrame, max_partitions: int | None = None) -> DataFrame:
    """Join neighbouring splits, without a shuffle, down to ``max_partitions``.

    The cost of trees and of logistic regression also grows with the number of
    partitions. That number is best set where the splits are made, by
    ``spark.sql.files.maxPartitionBytes``. A bound given here makes another
    forest, since bagging draws by partition; the other models stay the same up
    to rounding. Without a bound nothing is done.
    """
    return examples if max_partitions is None else examples.coalesce(max_partitions)


def fit_logistic(
    examples: DataFrame,
    num_classes: int = NUM_CLASSES,
    iterations: int = LOGISTIC_ITERATIONS,
    tolerance: float = LOGISTIC_TOLERANCE,
) -> LogisticRegressionModel:
    """Multinomial, no intercept, no regularization. One pass over ``examples``.

    The optimum is searched in passes over compact blocks of all rows, see
    ``tallyframe.operators.logistic``; ``model.losses`` holds the mean loss at zero
    and after each iteration. Spark's estimator is then fitted with these weights as
    its lower and upper bounds, so it gives a model of its own kind. What it was
    fitted on is a few rows, so ``model.summary`` tells nothing.
    """
    found = optimum(examples, num_classes, iterations, tolerance)
    rows, width = found.weights.shape
    bounds = DenseMatrix(rows, width, found.weights.ravel(order="F"))
    estimator = LogisticRegression(
        family="multinomial",
        fitIntercept=False,
        regParam=0.0,
        maxIter=0,
        tol=tolerance,
        lowerBoundsOnCoefficients=bounds,
        upperBoundsOnCoefficients=bounds,
        **_CLASS_ONLY,
    )
    # Of standard deviation 1 in every feature, so that the weights are not rounded.
    few = [(0.0, Vectors.dense([float(value)] * width)) for value in range(3)]
    shape = StructType([StructField("label", DoubleType()), StructField("features", VectorUDT())])
    few = examples.sparkSession.createDataFrame(few, shape).coalesce(1)
    model = estimator.fit(with_label_domain(few, num_classes))
    for name in ("lowerBoundsOnCoefficients", "upperBoundsOnCoefficients"):
        model.clear(model.getParam(name))
    model.set(model.maxIter, iterations)
    model.losses = found.losses
    return model


def fit_tree(
    examples: DataFrame, num_classes: int = NUM_CLASSES
) -> DecisionTreeClassificationModel:
    estimator = DecisionTreeClassifier(
        impurity=TREE_IMPURITY,
        maxDepth=TREE_DEPTH,
        maxBins=TREE_BINS,
        seed=TREE_SEED,
        **_CLASS_ONLY,
    )
    return estimator.fit(with_label_domain(examples, num_classes))


def fit_bayes(examples: DataFrame, labels: Sequence[float] | None = None) -> PipelineModel:
    """Multinomial naive Bayes over the classes that occur, whatever their labels.

    One pass: rows and sums of features for each label, combined in each task
    first. Spark's estimator is then fitted on these sums alone, a few rows a
    class. It numbers its classes 0, 1, ... in the order of the labels; they are
    mapped back after scoring, by a stage of the model. ``labels``, if given, are
    all that may occur.
    """
    totals = _sums_by_label(examples)
    found = [row["label"] for row in totals]
    if labels is not None and not set(found) <= set(labels):
        raise ValueError(f"labels not listed: {sorted(set(found) - set(labels))}")
    nothing = Vectors.sparse(totals[0]["sum"].size, {})
    # A row that holds the sums, and one that stands for the number of the others.
    rows = [
        (float(index), vector, weight)
        for index, row in enumerate(totals)
        for vector, weight in ((row["sum"], 1.0), (nothing, row["n"] - 1.0))
    ]
    shape = StructType(
        [
            StructField("class", DoubleType()),
            StructField("features", VectorUDT()),
            StructField("weight", DoubleType()),
        ]
    )
    estimator = NaiveBayes(
        modelType="multinomial",
        smoothing=BAYES_SMOOTHING,
        labelCol="class",
        weightCol="weight",
        predictionCol="__found",
        **_CLASS_ONLY,
    )
    few = examples.sparkSession.createDataFrame(rows, shape).coalesce(1)
    return _with_label_values(estimator.fit(few), found)


def _sums_by_label(examples: DataFrame) -> list[Row]:
    """(label, n, sum) of each label that occurs, in order. Negative features are refused."""
    measures = Summarizer.metrics("count", "sum", "min").summary(F.col("features"))
    totals = examples.groupBy("label").agg(measures.alias("m"))
    rows = totals.select("label", F.col("m.count").alias("n"), "m.sum", "m.min").collect()
    if not rows:
        raise ValueError("no examples to fit")
    if any(row["label"] is None or math.isnan(row["label"]) for row in rows):
        raise ValueError("a label is null or not a number")
    if any(min(row["min"].toArray(), default=0.0) < 0 for row in rows):
        raise ValueError("features must be nonnegative")
    return sorted(rows, key=lambda row: row["label"])


def _with_label_values(model: NaiveBayesModel, labels: Sequence[float]) -> PipelineModel:
    values = ", ".join(f"CAST('{label!r}' AS DOUBLE)" for label in labels)
    to_label = SQLTransformer(
        statement=(
            "SELECT * EXCEPT (`__found`), "
            f"element_at(array({values}), CAST(`__found` AS INT) + 1) AS `prediction` "
            "FROM __THIS__"
        )
    )
    return PipelineModel([model, to_label])


def fit_forest(
    examples: DataFrame, num_classes: int = NUM_CLASSES, num_trees: int = FOREST_TREES
) -> VotingForest:
    estimator = RandomForestClassifier(
        numTrees=num_trees,
        featureSubsetStrategy=FOREST_SUBSET,
        impurity=TREE_IMPURITY,
        maxDepth=TREE_DEPTH,
        maxBins=TREE_BINS,
        seed=FOREST_SEED,
    )
    return VotingForest(estimator.fit(with_label_domain(examples, num_classes)))


_FITS: dict[str, Callable[..., Transformer]] = {
    LOGISTIC.key: fit_logistic,
    TREE.key: fit_tree,
    BAYES.key: fit_bayes,
    FOREST.key: fit_forest,
}


# Passes each fit makes over its input before it works on a form of its own,
# which it keeps by itself: statistics, split candidates, conversion.
_PASSES = {LOGISTIC.key: 1, TREE.key: 3, BAYES.key: 1, FOREST.key: 3}


def worth_keeping(kinds: Iterable[ModelKind]) -> bool:
    """Whether caching the examples beats reading them again for every pass.

    Two passes over text cost about as much as one pass plus writing and
    reading the cache, and logistic regression keeps all rows once more.
    """
    return sum(_PASSES[kind.key] for kind in kinds) > 2


def fit(examples: DataFrame, kind: ModelKind, **options: float) -> Transformer:
    return _FITS[kind.key](examples, **options)


def fit_all(
    examples: DataFrame,
    kinds: Iterable[ModelKind] = ALL_KINDS,
    parallelism: int = 1,
    options: Mapping[str, Mapping[str, float]] | None = None,
    on_fitted: Callable[[ModelKind, Transformer], None] | None = None,
) -> dict[str, Transformer]:
    """Train several models on one frame, ``parallelism`` of them at a time.

    The frame should be cached, since each fit reads it again. On data that
    fills the cluster one fit after the other is best: each uses every core,
    and only one keeps its own form of the rows at a time. On small data,
    logistic regression is dozens of short jobs, and the other fits can run
    beside it. The models do not depend on ``parallelism``.

    ``options`` are further arguments of single fits, by key of the kind.
    ``on_fitted`` is called as each fit ends. When one fails no other is
    started, and those that run are cancelled.
    """
    kinds, options = list(kinds), options or {}

    def run(kind: ModelKind) -> Transformer:
        model = fit(examples, kind, **options.get(kind.key, {}))
        if on_fitted is not None:
            on_fitted(kind, model)
        return model

    if parallelism <= 1 or len(kinds) <= 1:
        return {kind.key: run(kind) for kind in kinds}
    context, tag = examples.sparkSession.sparkContext, f"fits-{uuid.uuid4().hex}"

    @inheritable_thread_target(examples.sparkSession)
    def tagged(kind: ModelKind) -> Transformer:
        context.addJobTag(tag)
        return run(kind)

    with ThreadPoolExecutor(max_workers=min(parallelism, len(kinds))) as pool:
        futures = {kind.key: pool.submit(tagged, kind) for kind in kinds}
        done, _ = wait(futures.values(), return_when=FIRST_EXCEPTION)
        failed = next((f for f in done if f.exception() is not None), None)
        if failed is not None:
            pool.shutdown(wait=False, cancel_futures=True)
            context.cancelJobsWithTag(tag)
            failed.result()
        return {key: future.result() for key, future in futures.items()}
