"""The registered queries: one or more per operator, each over a whole table."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import partial, reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures
from tallyframe.catalog import ALL_KINDS, BAYES, FOREST, LOGISTIC, TREE, ModelKind
from tallyframe.functions import majority_vote, vector_text
from tallyframe.functions.trees import table_of, with_tree_values
from tallyframe.operators import (
    accuracy,
    accuracy_lines,
    accuracy_metrics,
    accuracy_summary,
    comparison_report,
    correct_rows,
    error_rate,
    fit,
    fit_all,
    fit_bayes,
    model_report,
    plain_report,
    prediction_pairs,
    preview,
    score,
    score_all,
    wrong_rows,
)
from tallyframe.plans import score_saved, train_and_validate
from tallyframe.sources import (
    load_labelled,
    load_model,
    parse_labelled,
    probe_header,
    read_lines,
    rejected_lines,
    save_model,
    split_fields,
    strip_header,
)
from tallyframe.storage import new_shared_path

Query = Callable[[SparkSession, str], DataFrame]
Fixture = Callable[[SparkSession, str], DataFrame]


def _numbered(features: int) -> list:
    values = vector_to_array(F.col("features"))
    return [values[i].alias(f"f{i}") for i in range(features)]


# Sources.


def scan_lines(spark, sf_dir):
    return read_lines(spark, fixtures.raw_lines(spark, sf_dir))


def header_line(spark, sf_dir):
    paths = fixtures.raw_lines(spark, sf_dir)
    header = probe_header(spark, paths)
    matching = read_lines(spark, paths).filter(F.col("value").contains(header))
    return matching.agg(F.lit(header).alias("header"), F.count("*").alias("lines_with_header"))


def _stripped(spark, sf_dir):
    paths = fixtures.raw_lines(spark, sf_dir)
    return strip_header(read_lines(spark, paths), probe_header(spark, paths))


def split_into_fields(spark, sf_dir):
    cut = split_fields(_stripped(spark, sf_dir))
    return cut.select(
        "value",
        F.size("fields").cast("bigint").alias("n_fields"),
        F.concat_ws("|", "fields").alias("fields"),
    )


def parse_numeric(spark, sf_dir):
    return parse_labelled(_stripped(spark, sf_dir)).select(*_numbered(4), "label")


def parse_lenient(spark, sf_dir):
    lines = read_lines(spark, fixtures.raw_lines(spark, sf_dir))
    return parse_labelled(lines, strict=False).select(*_numbered(4), "label")


def reject_table(spark, sf_dir):
    return rejected_lines(read_lines(spark, fixtures.raw_lines(spark, sf_dir)))


def odd_rejects(spark, sf_dir):
    return rejected_lines(fixtures.odd_lines(spark, sf_dir), width=3)


def odd_examples(spark, sf_dir):
    kept = parse_labelled(fixtures.odd_lines(spark, sf_dir), width=3, strict=False)
    return kept.select(vector_text(F.col("features")).alias("features"), "label")


def label_last_field(spark, sf_dir):
    return load_labelled(spark, fixtures.raw_lines(spark, sf_dir)).select("label")


def feature_vector(spark, sf_dir):
    return load_labelled(spark, fixtures.raw_lines(spark, sf_dir)).select(*_numbered(4))


def labelled_examples(spark, sf_dir):
    return load_labelled(spark, fixtures.cell_lines(spark, sf_dir)).select("label", *_numbered(6))


def vector_as_text(spark, sf_dir):
    examples = load_labelled(spark, fixtures.raw_lines(spark, sf_dir))
    return examples.select(
        vector_text(F.col("features")).alias("features"),
        F.col("label").cast("string").alias("label"),
    )


# Training and scoring.


def _predict(fixture: Fixture, kind: ModelKind, spark, sf_dir):
    examples = fixture(spark, sf_dir)
    scored = score(examples, fit(examples, kind))
    return scored.select(*fixtures.KEYS, "label", "prediction")


def bayes_train_params(spark, sf_dir):
    model = fit_bayes(fixtures.graded(spark, sf_dir)).stages[0]
    theta = model.theta.toArray()
    rows = [
        (position, round(float(prior), 6), *[round(float(t), 6) for t in theta[position]])
        for position, prior in enumerate(model.pi)
    ]
    return spark.createDataFrame(
        rows, "class_index long, pi double, " + ", ".join(f"theta{j} double" for j in range(4))
    )


def hard_vote(spark, sf_dir):
    votes = fixtures.votes(spark, sf_dir)
    return majority_vote(votes, fixtures.vote_columns(), "winner").select(*fixtures.KEYS, "winner")


def _pairs(kind: ModelKind, spark, sf_dir):
    examples = fixtures.cells(spark, sf_dir)
    return prediction_pairs(examples, fit(examples, kind))


def _split_scored(spark, sf_dir):
    training, validation = fixtures.split_examples(spark, sf_dir)
    return score_all(validation, fit_all(training))


def models_side_by_side(spark, sf_dir):
    scored = _split_scored(spark, sf_dir)
    return scored.select(*fixtures.KEYS, "label", *[k.score_column for k in ALL_KINDS])


# Eleven features: models that all differ, each against another way to the same answer.


def _eleven(spark, sf_dir):
    examples = fixtures.eleven(spark, sf_dir)
    # Logistic regression beside the others, whose last tasks leave cores idle.
    models = fit_all(examples, parallelism=2)
    return models, score_all(examples, models)


def eleven_features(spark, sf_dir):
    _, scored = _eleven(spark, sf_dir)
    return scored.select(*fixtures.KEYS, "label", TREE.score_column, BAYES.score_column)


def _linear(x: Column, weights: Sequence[float], start: float) -> Column:
    return reduce(add, [F.lit(float(w)) * x[j] for j, w in enumerate(weights)], F.lit(float(start)))


def _greatest(x: Column, weights: np.ndarray, starts: np.ndarray, classes: Sequence[float]) -> Column:
    """The class whose weights give the most for ``x``, the first of equals.

    A batch of rows at a time: hundreds of products written out are a method that
    the JVM only interprets.
    """
    named = np.array(classes, float)

    @F.arrow_udf("double")
    def greatest(values: pa.Array) -> pa.Array:
        if not len(values):
            return pa.array([], pa.float64())
        columns = values.flatten().to_numpy().reshape(len(values), -1).T
        scores = np.tile(starts[:, None], len(values))
        for j in range(weights.shape[1]):
            scores += weights[:, j : j + 1] * columns[j]
        return pa.array(named[scores.argmax(axis=0)])

    return greatest(x)


def _by_hand(scored, models):
    """``scored`` with what each model's own parameters say, under ``own_`` and the model's key."""
    here = scored.withColumn("x", vector_to_array("features"))
    tree = models[TREE.key]
    table = table_of([tree.toDebugString])
    here = with_tree_values(here, F.col("x"), tree.numFeatures, table, ["own_tree"])
    weights = models[LOGISTIC.key].coefficientMatrix.toArray()
    nothing = np.zeros(len(weights))
    own_logistic = _greatest(F.col("x"), weights, nothing, range(len(weights)))
    bayes, to_label = models[BAYES.key].stages
    labels = [float(x) for x in re.findall(r"CAST\('([0-9.]+)' AS DOUBLE\)", to_label.getStatement())]
    own_bayes = _greatest(F.col("x"), bayes.theta.toArray(), bayes.pi.toArray(), labels)
    here = here.withColumns({"own_logistic": own_logistic, "own_bayes": own_bayes})
    votes = []
    for i, part in enumerate(models[FOREST.key].forest.trees):
        names = {"predictionCol": f"vote_{i}", "rawPredictionCol": "", "probabilityCol": ""}
        here = part.copy({part.getParam(k): v for k, v in names.items()}).transform(here)
        votes.append(f"vote_{i}")
    return majority_vote(here, votes, "own_forest")


def eleven_features_checked(spark, sf_dir):
    """Of each model: on how many rows it is what its parameters say, and which others it is nowhere apart from."""
    models, scored = _eleven(spark, sf_dir)
    # One pass counts for all models, then there is one row a model.
    same = {
        f"{kind.key}_{other.key}": F.sum((F.col(kind.score_column) == F.col(f"own_{other.key}")).cast("long"))
        for kind in ALL_KINDS
        for other in ALL_KINDS
    }
    counted = _by_hand(scored, models).agg(
        F.count("*").alias("examples"), *[total.alias(name) for name, total in same.items()]
    )
    rows = []
    for kind in ALL_KINDS:
        others = [
            (F.col(f"{kind.key}_{k.key}") == F.col("examples")).cast("int") for k in ALL_KINDS if k != kind
        ]
        rows.append(
            F.struct(
                F.lit(kind.title).alias("model"),
                "examples",
                F.col(f"{kind.key}_{kind.key}").alias("equal_to_own"),
                reduce(add, others).alias("models_equal_to_others"),
            )
        )
    return counted.select(F.inline(F.array(*rows)))


def logistic_optimum(spark, sf_dir):
    """Whether the gradient of the likelihood is near zero where logistic regression ended."""
    examples = fixtures.eleven(spark, sf_dir)
    weights = fit(examples, LOGISTIC).coefficientMatrix.toArray()
    classes, width = weights.shape

    here = examples.withColumn("x", vector_to_array("features"))
    here = here.withColumn("z", F.array(*[_linear(F.col("x"), row, 0.0) for row in weights]))
    here = here.withColumn("e", F.transform("z", lambda z: F.exp(z - F.array_max("z"))))
    total = reduce(add, [F.col("e")[c] for c in range(classes)])

    def steepest(chance: Callable[[int], Column]) -> Column:
        return F.greatest(
            *[
                F.abs(F.avg((chance(c) - (F.col("label") == c).cast("double")) * F.col("x")[j]))
                for c in range(classes)
                for j in range(width)
            ]
        )

    there = here.agg(
        F.count("*").alias("examples"),
        steepest(lambda c: F.col("e")[c] / total).alias("most"),
        steepest(lambda c: F.lit(1.0 / classes)).alias("at_zero"),
    )
    return there.select(
        "examples",
        (F.col("most") < 0.01 * F.col("at_zero")).alias("gradient_is_small"),
        (F.col("at_zero") > 0.1).alias("zero_is_no_optimum"),
    )


# Evaluation.


def _bayes_scored(spark, sf_dir):
    examples = fixtures.graded(spark, sf_dir)
    return score(examples, fit_bayes(examples))


def right_rows(spark, sf_dir):
    return correct_rows(_bayes_scored(spark, sf_dir)).select(
        *fixtures.KEYS, "label", "prediction"
    )


def false_rows(spark, sf_dir):
    return wrong_rows(_bayes_scored(spark, sf_dir)).select(*fixtures.KEYS, "label", "prediction")


def bayes_accuracy(spark, sf_dir):
    return accuracy(_bayes_scored(spark, sf_dir))


def bayes_error_rate(spark, sf_dir):
    return error_rate(_bayes_scored(spark, sf_dir))


def bayes_accuracy_metrics(spark, sf_dir):
    value = accuracy_metrics(_bayes_scored(spark, sf_dir))
    return spark.createDataFrame([(value,)], "accuracy double")


def _four_scored(fixture: Fixture, spark, sf_dir):
    examples = fixture(spark, sf_dir)
    return score_all(examples, fit_all(examples))


def _summary(fixture: Fixture, spark, sf_dir):
    return accuracy_summary(_four_scored(fixture, spark, sf_dir))


def summary_lines(spark, sf_dir):
    return accuracy_lines(accuracy_summary(_split_scored(spark, sf_dir)), "validation")


# Reports, saved models and whole runs.


def _model_report(kind: ModelKind, training: bool, spark, sf_dir):
    examples = fixtures.cells(spark, sf_dir)
    return model_report(score(examples, fit(examples, kind)), kind, training=training)


def three_plain_columns(spark, sf_dir):
    examples = fixtures.halves(spark, sf_dir)
    return plain_report(score(examples, fit(examples, TREE)))


def four_model_report(spark, sf_dir):
    return comparison_report(_split_scored(spark, sf_dir))


def report_preview(spark, sf_dir):
    scored = _four_scored(fixtures.cells, spark, sf_dir)
    ordered = scored.orderBy(*fixtures.KEYS, "label", vector_text(F.col("features")))
    return preview(comparison_report(ordered))


def _round_trip(kind: ModelKind, spark, sf_dir):
    examples = fixtures.cells(spark, sf_dir)
    path = new_shared_path(spark, kind.directory)
    save_model(fit(examples, kind), path)
    scored = score(examples, load_model(path, kind))
    return scored.select(*fixtures.KEYS, "label", "prediction")


def train_run_summary(spark, sf_dir):
    report = new_shared_path(spark, "report")
    return train_and_validate(
        spark, *fixtures.split_lines(spark, sf_dir), report_path=report
    ).summary


def train_run_report(spark, sf_dir):
    return train_and_validate(spark, *fixtures.split_lines(spark, sf_dir)).report


def _training_run(kind: ModelKind, spark, sf_dir):
    training, validation = fixtures.split_lines(spark, sf_dir)
    header = fixtures.SPLIT_HEADER
    return train_and_validate(spark, training, validation, kinds=[kind], header=header).report


def _prediction_run(kind: ModelKind, spark, sf_dir):
    training, validation = fixtures.split_lines(spark, sf_dir)
    directory = new_shared_path(spark, "models")
    train_and_validate(spark, training, training, kinds=[kind], model_directory=directory)
    return score_saved(spark, validation, directory, kinds=[kind]).report


def single_model_run(spark, sf_dir):
    return train_and_validate(spark, *fixtures.split_lines(spark, sf_dir), kinds=[TREE]).summary


def saved_model_run(spark, sf_dir):
    training, validation = fixtures.split_lines(spark, sf_dir)
    directory = new_shared_path(spark, "models")
    train_and_validate(spark, training, training, model_directory=directory)
    report = new_shared_path(spark, "report")
    return score_saved(spark, validation, directory, report_path=report).report


def _imperfect_run(spark, sf_dir):
    rejects = new_shared_path(spark, "rejects")
    run = train_and_validate(
        spark,
        *fixtures.imperfect_lines(spark, sf_dir),
        report_path=new_shared_path(spark, "report"),
        strict_width=True,
        rejects_path=rejects,
    )
    return run, rejects


def imperfect_run_report(spark, sf_dir):
    return _imperfect_run(spark, sf_dir)[0].report


def imperfect_run_rejects(spark, sf_dir):
    run, rejects = _imperfect_run(spark, sf_dir)
    parts = [
        spark.read.text(f"{rejects}/{source}").select(F.lit(source).alias("source"), "value")
        for source in run.rejects
    ]
    return reduce(DataFrame.union, parts)


def imperfect_run_counts(spark, sf_dir):
    run, _ = _imperfect_run(spark, sf_dir)
    rows = [(source, seen["lines"], seen["rejected"]) for source, seen in run.rejects.items()]
    return spark.createDataFrame(rows, "source string, lines long, rejected long")


def empty_validation_lines(spark, sf_dir):
    training, _ = fixtures.split_lines(spark, sf_dir)
    run = train_and_validate(spark, training, fixtures.header_only(spark), kinds=[TREE, BAYES])
    trained_on = load_labelled(spark, training).count()
    return accuracy_lines(run.summary).withColumn("trained_on", F.lit(trained_on).cast("bigint"))


QUERIES: dict[str, Query] = {
    "scan_lines": scan_lines,
    "header_line": header_line,
    "strip_header": _stripped,
    "split_fields": split_into_fields,
    "parse_numeric": parse_numeric,
    "parse_lenient": parse_lenient,
    "rejected_lines": reject_table,
    "rejected_odd_lines": odd_rejects,
    "parse_odd_lines": odd_examples,
    "label_last_field": label_last_field,
    "feature_vector": feature_vector,
    "labelled_examples": labelled_examples,
    "vector_text": vector_as_text,
    "bayes_train_params": bayes_train_params,
    "bayes_predict": partial(_predict, fixtures.graded, BAYES),
    "tree_predict": partial(_predict, fixtures.graded, TREE),
    "forest_vote_predict": partial(_predict, fixtures.graded, FOREST),
    "logistic_predict": partial(_predict, fixtures.halves, LOGISTIC),
    **{
        f"{kind.key}_predict_noisy": partial(_predict, fixtures.cells, kind)
        for kind in ALL_KINDS
    },
    "hard_vote": hard_vote,
    **{f"prediction_pairs_{kind.key}": partial(_pairs, kind) for kind in ALL_KINDS},
    "models_side_by_side": models_side_by_side,
    "eleven_features": eleven_features,
    "eleven_features_checked": eleven_features_checked,
    "logistic_optimum": logistic_optimum,
    "correct_rows": right_rows,
    "wrong_rows": false_rows,
    "accuracy": bayes_accuracy,
    "error_rate": bayes_error_rate,
    "accuracy_metrics": bayes_accuracy_metrics,
    "accuracy_summary": partial(_summary, fixtures.halves),
    "accuracy_summary_noisy": partial(_summary, fixtures.cells),
    "accuracy_lines": summary_lines,
    **{
        f"{role}_report_{kind.key}": partial(_model_report, kind, role == "training")
        for role in ("training", "prediction")
        for kind in ALL_KINDS
    },
    "plain_report": three_plain_columns,
    "comparison_report": four_model_report,
    "report_preview": report_preview,
    **{f"model_round_trip_{kind.key}": partial(_round_trip, kind) for kind in ALL_KINDS},
    "train_run_summary": train_run_summary,
    "train_run_report": train_run_report,
    **{f"training_run_{kind.key}": partial(_training_run, kind) for kind in ALL_KINDS},
    **{f"prediction_run_{kind.key}": partial(_prediction_run, kind) for kind in ALL_KINDS},
    "single_model_run": single_model_run,
    "empty_validation_lines": empty_validation_lines,
    "imperfect_run_report": imperfect_run_report,
    "imperfect_run_rejects": imperfect_run_rejects,
    "imperfect_run_counts": imperfect_run_counts,
    "saved_model_run": saved_model_run,
}
