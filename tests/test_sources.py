import math

import pytest

from tallyframe.operators import accuracy, error_rate
from tallyframe.sources import (
    load_labelled,
    parse_labelled,
    probe_header,
    read_lines,
    rejected_lines,
    split_fields,
    strip_header,
)


def lines_of(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def parsed(frame):
    return [(row["label"], list(row["features"])) for row in frame.collect()]


def test_header_is_the_first_line_of_the_first_file_by_name(spark, write_files):
    # The larger file comes first in a directory scan, but not by name.
    path = write_files({"b.csv": "other\n" + "1;2\n" * 5000, "a.csv": "x;y\n1;2\n"})
    assert probe_header(spark, path) == "x;y"
    assert probe_header(spark, [f"{path}/b.csv", f"{path}/a.csv"]) == "other"


def test_empty_files_before_the_header_are_skipped(spark, write_files):
    assert probe_header(spark, write_files({"a.csv": "", "b.csv": "x;y\n1;2\n"})) == "x;y"


def test_file_names_with_blanks_and_glob_characters(spark, write_files):
    path = write_files({"a [1] {2} 3%.csv": "x;y\n1;2\n"})
    assert probe_header(spark, path) == "x;y"


def test_an_empty_source_is_an_error(spark, write_files):
    with pytest.raises(ValueError, match="no lines"):
        probe_header(spark, write_files({"a.csv": ""}))


def test_every_line_containing_the_header_goes(spark):
    kept = strip_header(lines_of(spark, "x;y", "1;2", "0;x;y;3", "x; y", "x;y"), "x;y")
    assert [row["value"] for row in kept.collect()] == ["1;2", "x; y"]


def test_a_blank_header_drops_everything(spark):
    assert strip_header(lines_of(spark, "", "1;2"), "").count() == 0


@pytest.mark.parametrize(
    "line, fields",
    [
        ("1;2;;", ["1", "2"]),
        (";1;;2", ["", "1", "", "2"]),
        ("1", ["1"]),
        ("", [""]),
        ('"a;b";c', ['"a', 'b"', "c"]),
    ],
)
def test_split(spark, line, fields):
    assert split_fields(lines_of(spark, line)).first()["fields"] == fields


def test_trailing_empty_fields_move_the_label(spark):
    rows = parsed(parse_labelled(lines_of(spark, "1;2;3", "4;5;;", "6")))
    assert rows == [(3.0, [1.0, 2.0]), (5.0, [4.0]), (6.0, [])]


def test_accepted_number_forms(spark):
    line = " 1.5 ;1e3;0x1p3;1.0d;-2;NaN;Infinity;-Infinity;1e999;3"
    (label, features) = parsed(parse_labelled(lines_of(spark, line)))[0]
    assert label == 3.0
    assert features[:5] == [1.5, 1000.0, 8.0, 1.0, -2.0]
    assert math.isnan(features[5])
    assert features[6:] == [math.inf, -math.inf, math.inf]


@pytest.mark.parametrize("field", ["abc", "", "1,5", "nan", "inf", "+INF", "infinity", "NAN"])
def test_a_field_that_is_no_number_fails_the_job(spark, field):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|not a number"):
        parse_labelled(lines_of(spark, "1;2", f"1;{field};2")).collect()


@pytest.mark.parametrize("field", ["abc", "", "nan"])
def test_bad_fields_fail_without_ansi_casts_too(spark, field):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert parsed(parse_labelled(lines_of(spark, "1;2"))) == [(2.0, [1.0])]
        with pytest.raises(Exception, match="not a number"):
            parse_labelled(lines_of(spark, "1;2", f"1;{field};2")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_width_is_checked_on_request(spark, write_files):
    path = write_files({"a.csv": "x;y;z\n1;2;3\n1;2\n"})
    assert load_labelled(spark, path).count() == 2
    with pytest.raises(Exception, match="expected 3 fields"):
        load_labelled(spark, path, strict_width=True).collect()


def test_parsed_and_rejected_lines_are_the_whole_input(spark):
    lines = lines_of(spark, "1;2", "a;2", "3;4;5", "inf;1", "NaN;1", ";;", "7;8;")
    good = parse_labelled(lines, width=2, strict=False)
    bad = rejected_lines(lines, width=2)
    assert sorted(row["value"] for row in bad.collect()) == ["3;4;5", ";;", "a;2", "inf;1"]
    assert good.count() + bad.count() == lines.count()


def test_several_paths_and_line_ends(spark, write_files):
    one = write_files({"a.csv": "x;y\r\n1;2\r\n"}, "one")
    two = write_files({"a.csv": "x;y\n3;4"}, "two")
    assert sorted(r["value"] for r in read_lines(spark, [one, two]).collect()) == [
        "1;2",
        "3;4",
        "x;y",
        "x;y",
    ]
    assert sorted(parsed(load_labelled(spark, [one, two]))) == [(2.0, [1.0]), (4.0, [3.0])]


def test_a_header_only_source_scores_nan(spark, write_files):
    from pyspark.sql import functions as F

    empty = load_labelled(spark, write_files({"a.csv": "x;y\n"}))
    scored = empty.withColumn("prediction", F.lit(1.0))
    assert math.isnan(accuracy(scored).first()["accuracy"])
    assert math.isnan(error_rate(scored).first()["error_rate"])


@pytest.mark.parametrize("line", ["a;2", "1;2;3", "inf;1", "1;nAn"])
def test_counting_is_as_strict_as_reading(spark, line):
    lines = spark.createDataFrame([("1;2",), (line,)], "value string")
    with pytest.raises(Exception):
        parse_labelled(lines, width=2).count()
    assert parse_labelled(lines, width=2, strict=False).count() == 1


def test_the_probe_runs_as_many_jobs_however_many_files_are_empty(spark, write_files):
    def jobs(files, directory, group):
        path = write_files(files, directory)
        spark.sparkContext.setJobGroup(group, "")
        assert probe_header(spark, path) == "h;l"
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    few = jobs({"z.csv": "h;l\n1;2\n"}, "few", "probe-few")
    many = {f"a{i:02}.csv": "" for i in range(30)} | {"z.csv": "h;l\n1;2\n"}
    assert jobs(many, "many", "probe-many") <= few + 1


def test_lenient_parse_stays_in_generated_code(spark):
    lines = spark.createDataFrame([("1;2",)], "value string")
    plan = parse_labelled(lines, strict=False)._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan and plan.count("array<double>") <= 2
