import io
from contextlib import redirect_stdout

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallyframe import ALL_KINDS, BAYES, TREE
from tallyframe.functions.text import cut_cell
from tallyframe.operators import (
    accuracy,
    accuracy_lines,
    accuracy_summary,
    comparison_report,
    error_rate,
    model_report,
    preview,
    wrong_rows,
    correct_rows,
    write_report,
)


def text_schema(*names):
    return StructType([StructField(name, StringType(), False) for name in names])


@pytest.fixture(scope="module")
def scored(spark):
    rows = [
        (5.0, Vectors.dense(7.4, 0.7, 1e-4, 1e7), 5.0, 6.0, 5.0, 5.0),
        (6.0, Vectors.dense(-1.0, 0.0, 2.5, float("nan")), 5.0, 6.0, 6.0, 5.0),
    ]
    columns = ["label", "features", *[k.score_column for k in ALL_KINDS]]
    return spark.createDataFrame(rows, columns)


def test_comparison_report(scored):
    report = comparison_report(scored)
    assert report.schema == text_schema(
        "Features", "Actual Label", "Logistic Reg", "DecisionTree", "Naive Bayes ", "RandomForest"
    )
    assert [tuple(row) for row in report.collect()] == [
        ("[7.4,0.7,1.0E-4,1.0E7]", "5.0", "5.0", "6.0", "5.0", "5.0"),
        ("[-1.0,0.0,2.5,NaN]", "6.0", "5.0", "6.0", "6.0", "5.0"),
    ]


@pytest.mark.parametrize("kind", ALL_KINDS, ids=lambda k: k.key)
def test_single_model_report_titles(scored, kind):
    column = kind.score_column
    names = ("Features", "Actual Label")
    training = model_report(scored, kind, column, training=True)
    assert training.schema == text_schema(*names, f"{kind.title} Prediction")
    assert model_report(scored, kind, column).columns == [*names, kind.prediction_column]


def test_a_null_fails_instead_of_being_printed(scored):
    broken = scored.withColumn("label", F.when(F.col("label") > 5, F.col("label")))
    with pytest.raises(Exception, match="null in Actual Label"):
        model_report(broken, TREE, TREE.score_column).collect()


def test_preview_is_what_show_prints(spark):
    rows = [("x" * n, str(n), "y") for n in range(1, 31)]
    report = spark.createDataFrame(rows, ["Features", "Actual Label", "Naive Bayes "])
    shown = io.StringIO()
    with redirect_stdout(shown):
        report.show()
    printed = [
        tuple(cell.strip() for cell in line.strip("|").split("|"))
        for line in shown.getvalue().splitlines()
        if line.startswith("|")
    ][1:]
    assert printed == [tuple(row) for row in preview(report).collect()]
    assert len(printed) == 20


def test_the_preview_of_a_sorted_frame_sorts_no_whole_frame(scored):
    ordered = scored.orderBy("label")
    text = io.StringIO()
    with redirect_stdout(text):
        preview(comparison_report(ordered)).explain()
    assert "TakeOrderedAndProject" in text.getvalue() and "Exchange" not in text.getvalue()


@pytest.mark.parametrize("width", [0, 2, 3, 4, 20])
def test_cut_cells(spark, width):
    texts = ["", None, "a" * 20, "a" * 21, "b" * 20 + "\n", "\n" * 30, "\U0001f600" * 21, "$1\\" * 9, "abcd"]
    kept = max(width - 3, 0)
    wanted = [t if t is None or len(t) <= width else t[:kept] + "..." for t in texts]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string").orderBy("i")
    assert [row[0] for row in frame.select(cut_cell(F.col("t"), width)).collect()] == wanted


def test_summary_order_and_lines(scored):
    summary = accuracy_summary(scored)
    assert [tuple(row) for row in summary.collect()] == [
        ("Logistic Regression", 0.5),
        ("Decision Tree", 0.5),
        ("Naive Bayes", 1.0),
        ("Random Forest", 0.5),
    ]
    assert [row["line"] for row in accuracy_lines(summary).collect()] == [
        "Accuracy = 0.5 (Logistic Regression)",
        "Accuracy = 0.5 (Decision Tree)",
        "Accuracy = 1.0 (Naive Bayes)",
        "Accuracy = 0.5 (Random Forest)",
    ]
    single = accuracy_lines(accuracy_summary(scored, [BAYES]), "Test.csv").collect()
    assert [row["line"] for row in single] == ["Accuracy = 1.0 (Naive Bayes on Test.csv)"]


def test_right_and_wrong_rows_are_all_rows(scored):
    column = TREE.score_column
    assert [r["label"] for r in correct_rows(scored, column).collect()] == [6.0]
    assert [r["label"] for r in wrong_rows(scored, column).collect()] == [5.0]


def test_nan_counts_as_equal_to_nan(spark):
    frame = spark.createDataFrame([(float("nan"), float("nan"))], ["prediction", "label"])
    assert correct_rows(frame).count() == 1


def test_write_report(spark, scored, tmp_path):
    path = str(tmp_path / "report")
    report = comparison_report(scored)
    write_report(report, path)
    assert spark.read.parquet(path).columns == report.columns
    with pytest.raises(Exception, match="already exists"):
        write_report(report, path)
    write_report(report, path, overwrite=True)


def test_every_model_keeps_its_own_column(spark):
    # Four models that each predict another constant: no two can be taken for each other.
    row = (1.0, Vectors.dense(0.5), 0.0, 1.0, 2.0, 3.0)
    columns = ["label", "features", *[k.score_column for k in ALL_KINDS]]
    scored = spark.createDataFrame([row, row], columns)
    report = comparison_report(scored).first()
    assert [report[k.prediction_column] for k in ALL_KINDS] == ["0.0", "1.0", "2.0", "3.0"]
    lines = [r.line for r in accuracy_lines(accuracy_summary(scored)).collect()]
    assert lines == [
        f"Accuracy = {float(k == ALL_KINDS[1])} ({k.title})" for k in ALL_KINDS
    ]


def test_null_labels_are_refused_by_every_measure(spark):
    frame = spark.createDataFrame([(1.0, 1.0), (1.0, None), (1.0, 2.0)], "prediction double, label double")
    for measure in (accuracy, error_rate, correct_rows, wrong_rows):
        with pytest.raises(Exception, match="null in"):
            measure(frame).collect()
