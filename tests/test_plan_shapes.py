"""What must hold of the plans at any size of the data."""

import io
import re
from contextlib import redirect_stdout

import pytest

from checks import fixtures, registry
from conftest import SF_DIR
from tallyframe import FOREST, TREE
from tallyframe.operators import accuracy_summary, comparison_report, fit, fit_all, score_all
from tallyframe.sources import load_labelled

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "PythonUDF")


def explained(frame, mode="formatted"):
    text = io.StringIO()
    with redirect_stdout(text):
        frame.explain(mode)
    return text.getvalue()


@pytest.fixture(scope="module")
def scored(spark):
    text = load_labelled(spark, fixtures.cell_lines(spark, SF_DIR))
    return score_all(text, fit_all(fixtures.cells(spark, SF_DIR)))


def test_report_is_one_stage_without_python(scored):
    plan = explained(comparison_report(scored))
    assert "Exchange" not in plan and "Join" not in plan
    assert not any(node in plan for node in PYTHON_NODES)


def test_report_is_one_span_of_compilable_code(scored):
    code = explained(comparison_report(scored), "codegen")
    assert "Found 1 WholeStageCodegen subtrees" in code
    # The JVM does not compile methods of more than 8000 bytes.
    assert max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", code))) < 8000


def test_summary_shuffles_one_partial_row_per_task(scored):
    plan = explained(accuracy_summary(scored))
    tree = plan.split("\n\n")[0]
    assert tree.count("Exchange") == 1
    assert "partial_avg" in plan and "SinglePartition" in plan
    assert not any(node in plan for node in PYTHON_NODES)


def test_one_accuracy_runs_one_model(scored):
    plan = explained(accuracy_summary(scored, [TREE]))
    assert plan.count("UDF(") == 2  # the vector, and the tree on it
    assert "__tally" not in plan and "logistic_prediction" not in plan


def test_table_scans_read_only_the_columns_in_use(spark):
    plan = explained(fixtures.halves(spark, SF_DIR).select("label", "features"))
    assert "ReadSchema: struct<l_quantity:double>" in plan


def test_the_forest_is_one_conversion_and_expressions(spark):
    examples = fixtures.cells(spark, SF_DIR)
    forest = fit(examples, FOREST)
    plan = explained(forest.transform(examples).select("prediction"))
    # The vector is made and taken apart; no call for a tree.
    assert plan.count("UDF(") == 2 and "Exchange" not in plan
    code = explained(forest.transform(examples).select("prediction"), "codegen")
    assert max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", code))) < 8000


def test_scores_of_a_table_are_compilable_code(spark):
    examples = fixtures.cells(spark, SF_DIR)
    scored = score_all(examples, fit_all(examples, options={"logistic": {"iterations": 3}}))
    for frame in (scored.drop("features"), comparison_report(scored)):
        code = explained(frame, "codegen")
        assert max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", code))) < 8000


def test_all_models_are_checked_in_one_pass_of_compilable_code(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else the code is not known before the run
    try:
        checked = registry.eleven_features_checked(spark, SF_DIR)
        assert explained(checked, "simple").count("FileScan") == 1
        code = explained(checked, "codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    found = list(map(int, re.findall(r"maxMethodCodeSize:(\d+)", code)))
    assert found and max(found) < 8000
