import sys

import pytest

from checks import fixtures
from conftest import SF_DIR
from tallyframe import ALL_KINDS, BAYES, FOREST, LOGISTIC, TREE
from tallyframe.__main__ import main
from tallyframe.operators import training
from tallyframe.operators.training import worth_keeping
from tallyframe.plans import TooManyRejects, score_saved, train_and_validate


@pytest.fixture(scope="module")
def lines(spark):
    return fixtures.cell_lines(spark, SF_DIR)


def test_both_runs_with_and_without_a_written_report(spark, lines, tmp_path):
    models = str(tmp_path / "models")
    lazy = train_and_validate(spark, lines, lines, model_directory=models)
    written = score_saved(spark, lines, models, report_path=str(tmp_path / "report"))
    assert list(lazy.models) == list(written.models) == [k.key for k in ALL_KINDS]
    assert lazy.report.exceptAll(written.report).count() == 0
    assert lazy.report.count() == written.report.count() == 6000
    # Counted while writing, and counted by a query of its own.
    assert written.summary.collect() == lazy.summary.collect()


def test_examples_are_kept_only_for_more_than_two_passes():
    assert not worth_keeping([BAYES]) and not worth_keeping([LOGISTIC])
    assert worth_keeping([TREE]) and worth_keeping([FOREST]) and worth_keeping(ALL_KINDS)


def test_training_data_is_released(spark, lines):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    train_and_validate(spark, lines, lines, kinds=iter([BAYES, TREE]))
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_single_model_runs_name_their_column(spark, lines, tmp_path):
    models = str(tmp_path / "models")
    trained = train_and_validate(spark, lines, lines, [TREE], model_directory=models)
    assert trained.report.columns[-1] == "Decision Tree Prediction"
    assert score_saved(spark, lines, models, [TREE]).report.columns[-1] == "DecisionTree"


def test_existing_models_are_kept(spark, lines, tmp_path):
    models = str(tmp_path / "models")
    train_and_validate(spark, lines, lines, [BAYES], model_directory=models)
    with pytest.raises(Exception, match="already exists"):
        train_and_validate(spark, lines, lines, [BAYES], model_directory=models)
    train_and_validate(
        spark, lines, lines, [BAYES], model_directory=models, overwrite_models=True
    )


def test_a_header_only_test_set_gives_nan_and_an_empty_report(spark, lines, tmp_path):
    models = str(tmp_path / "models")
    train_and_validate(spark, lines, lines, [BAYES, TREE], model_directory=models)
    (tmp_path / "test.csv").write_text("a;b\n")
    for report in (None, str(tmp_path / "report")):
        run = score_saved(
            spark, str(tmp_path / "test.csv"), models, [TREE, BAYES], report_path=report
        )
        assert run.report.count() == 0
        assert [(r.model, str(r.accuracy)) for r in run.summary.collect()] == [
            ("Decision Tree", "nan"),
            ("Naive Bayes", "nan"),
        ]


def test_command_line(spark, lines, tmp_path, capsys):
    models = str(tmp_path / "models")
    choice = ["--kind", "bayes", "--kind", "tree"]
    main(["train", "--training", lines, "--validation", lines, "--models", models, *choice])
    trained = capsys.readouterr().out
    main(["predict", "--testing", lines, "--models", models, "--dataset-name", "T.csv", *choice])
    predicted = capsys.readouterr().out
    assert "|            Features|Actual Label|DecisionTree|Naive Bayes |" in trained
    assert trained.splitlines()[-1].endswith("(Naive Bayes)")
    assert predicted.splitlines()[-2].endswith("(Decision Tree on T.csv)")
    with pytest.raises(SystemExit):
        main(["predict", "--testing", lines])


def test_existing_paths_are_refused_before_any_job(spark, lines, tmp_path):
    (tmp_path / "models" / BAYES.directory).mkdir(parents=True)
    (tmp_path / "report").mkdir()
    spark.sparkContext.setJobGroup("early", "")
    for paths in ({"model_directory": str(tmp_path / "models")}, {"report_path": str(tmp_path / "report")}):
        with pytest.raises(FileExistsError):
            train_and_validate(spark, lines, lines, [BAYES], **paths)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("early")


def test_models_are_saved_as_their_fits_end(spark, lines, tmp_path, monkeypatch):
    def failing(frame, **options):
        raise ValueError("no fit")

    monkeypatch.setitem(training._FITS, FOREST.key, failing)
    with pytest.raises(ValueError, match="no fit"):
        train_and_validate(spark, lines, lines, [TREE, FOREST], model_directory=str(tmp_path / "m"))
    assert [p.name for p in (tmp_path / "m").iterdir()] == [TREE.directory]


def counted_fits(monkeypatch, failing=()):
    """The keys of the fits that are begun from here on; those in ``failing`` fail."""
    begun = []

    def watched(key, real):
        def run(frame, **options):
            begun.append(key)
            if key in failing:
                raise ValueError("no fit")
            return real(frame, **options)

        return run

    for key, real in dict(training._FITS).items():
        monkeypatch.setitem(training._FITS, key, watched(key, real))
    return begun


def test_a_failed_run_is_taken_up_where_it_ended(spark, lines, tmp_path, monkeypatch):
    paths = {"model_directory": str(tmp_path / "m"), "report_path": str(tmp_path / "report")}
    with monkeypatch.context() as patch:
        begun = counted_fits(patch, failing=[BAYES.key])
        with pytest.raises(ValueError, match="no fit"):
            train_and_validate(spark, lines, lines, **paths)
        assert begun == ["logistic", "tree", "bayes"]
    # A save that broke off leaves a folder without a record.
    (tmp_path / "m" / FOREST.directory / "data").mkdir(parents=True)
    with pytest.raises(FileExistsError):
        train_and_validate(spark, lines, lines, **paths)
    begun = counted_fits(monkeypatch)
    run = train_and_validate(spark, lines, lines, resume=True, **paths)
    assert begun == ["bayes", "forest"] and run.resumed == ("logistic", "tree")
    assert list(run.models) == [k.key for k in ALL_KINDS]
    # The report is whole now and stands; models alone are loaded without any fit.
    with pytest.raises(FileExistsError):
        train_and_validate(spark, lines, lines, resume=True, **paths)
    begun.clear()
    again = train_and_validate(spark, lines, lines, resume=True, model_directory=paths["model_directory"])
    assert begun == [] and again.resumed == tuple(k.key for k in ALL_KINDS)
    assert again.summary.collect() == run.summary.collect()
    whole = train_and_validate(spark, lines, lines)
    assert whole.report.exceptAll(run.report).count() == 0


def test_only_equal_fits_are_taken_up(spark, write_files, tmp_path, monkeypatch):
    source = write_files({"t.csv": "a;b;l\n1;0;3\n1;0;3\n0;1;5\n"})
    run = {"kinds": [TREE, BAYES], "model_directory": str(tmp_path / "m"), "resume": True}
    train_and_validate(spark, source, source, **run)
    with pytest.raises(ValueError, match="fitted otherwise: strict_width"):
        train_and_validate(spark, source, source, strict_width=True, **run)
    with open(f"{source}/u.csv", "w") as file:
        file.write("1;1;5\n")
    with pytest.raises(ValueError, match="fitted otherwise: bytes, files, marks, sum"):
        train_and_validate(spark, source, source, **run)
    begun = counted_fits(monkeypatch)
    train_and_validate(spark, source, source, overwrite_models=True, **run)
    assert begun == ["tree", "bayes"]
    with pytest.raises(ValueError, match="model directory"):
        train_and_validate(spark, source, source, resume=True)


def test_a_report_that_broke_off_is_written_anew(spark, lines, tmp_path):
    run = {"kinds": [BAYES], "model_directory": str(tmp_path / "m"), "report_path": str(tmp_path / "r")}
    (tmp_path / "r" / "_temporary").mkdir(parents=True)
    with pytest.raises(FileExistsError):
        train_and_validate(spark, lines, lines, **run)
    assert train_and_validate(spark, lines, lines, resume=True, **run).report.count() == 6000


BROKEN = "a;b;l\n1;0;3\n1;x;3\n0;1;5\n0;1;5;\n0;1\n\n1;0;3\n"


@pytest.mark.parametrize("report", [None, "report"])
def test_rejects_are_written_and_counted(spark, write_files, tmp_path, report):
    source = write_files({"t.csv": BROKEN})
    run = train_and_validate(
        spark, source, source, [TREE, BAYES], strict_width=True, max_rejects=3,
        report_path=report and str(tmp_path / report), rejects_path=str(tmp_path / "rejects"),
        model_directory=str(tmp_path / "m"),
    )
    assert run.rejects == {k: {"lines": 7, "rejected": 3} for k in ("training", "validation")}
    assert run.report.count() == 4
    for name in run.rejects:
        found = spark.read.text(str(tmp_path / "rejects" / name)).collect()
        assert sorted(r["value"] for r in found) == ["", "0;1", "1;x;3"]
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0
    scored = score_saved(
        spark, source, str(tmp_path / "m"), [TREE], strict_width=True,
        rejects_path=str(tmp_path / "more"),
    )
    assert scored.rejects == {"testing": {"lines": 7, "rejected": 3}} and scored.report.count() == 4


def test_too_many_rejects_end_the_run_before_a_fit(spark, write_files, tmp_path, monkeypatch):
    source, begun = write_files({"t.csv": BROKEN}), counted_fits(monkeypatch)
    run = {"kinds": [TREE], "rejects_path": str(tmp_path / "rejects"), "header": "a;b;l"}
    with pytest.raises(TooManyRejects, match="2 of 7 training lines"):
        train_and_validate(spark, source, source, max_rejects=1, **run)
    assert begun == [] and spark.read.text(str(tmp_path / "rejects" / "training")).count() == 2
    with pytest.raises(FileExistsError):
        train_and_validate(spark, source, source, **run)
    with pytest.raises(ValueError, match="needs a path"):
        train_and_validate(spark, source, source, max_rejects=1)
    with pytest.raises(Exception, match="not a number|CAST"):
        train_and_validate(spark, source, source, [TREE])


def test_resume_and_rejects_from_the_command_line(spark, write_files, tmp_path, capsys):
    source = write_files({"t.csv": BROKEN})
    paths = ["--training", source, "--validation", source, "--models", str(tmp_path / "m")]
    choice = ["--kind", "tree", "--rejects", str(tmp_path / "rejects"), "--resume", "--strict-width"]
    for _ in range(2):
        main(["train", *paths, *choice])
        assert "Rejected 3 of 7 validation lines" in capsys.readouterr().out


def test_the_number_of_partitions_is_left_alone(spark, lines):
    from tallyframe.operators import bounded_partitions

    frame = spark.range(100, numPartitions=7)
    assert bounded_partitions(frame) is frame
    assert bounded_partitions(frame, 3).rdd.getNumPartitions() == 3


def test_scores_are_those_of_the_validation_set(spark, write_files):
    train = write_files({"t.csv": "a;b;l\n1;0;3\n1;0;3\n0;1;5\n"}, "train")
    check = write_files({"v.csv": "a;b;l\n1;0;5\n0;1;5\n"}, "check")
    run = train_and_validate(spark, train, check, [BAYES, TREE], header="a;b;l", keep=False)
    assert run.report.count() == 2
    assert {r.accuracy for r in run.summary.collect()} == {0.5}
