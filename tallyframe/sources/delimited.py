"""Semicolon-separated text to labelled examples.

Everything here is a narrow projection or filter over ``spark.read.text``: no
shuffle and no Python code on the executors. The only thing that reaches the
driver is the header line.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions.settled import settled

SEPARATOR = ";"

# Spark reads 'inf' and 'nan' in any case as numbers. The accepted spellings
# are exactly NaN and Infinity, with an optional sign and outer blanks.
_BAD_SPECIAL = (
    r"(?:^|;)[\x00-\x20]*[+-]?"
    r"(?!(?:NaN|Infinity)[\x00-\x20]*(?:;|$))"
    r"(?i:nan|inf|infinity)[\x00-\x20]*(?:;|$)"
)
_GLOB_CHARACTERS = re.compile(r"([\\*?\[\]{}])")


def _as_list(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row (``value``) per line of the given files or directories."""
    return spark.read.text(_as_list(paths)).select("value")


def probe_header(spark: SparkSession, paths: str | Sequence[str]) -> str:
    """First line of the source, in the order of paths and file names.

    A directory scan hands out its largest splits first, so ``first()`` on the
    whole source may come from any file. The first file by name that is not
    empty is found from the listing, as an aggregate on the executors, and then
    read by itself. A compressed file may hold no line; then the next one is asked for.
    """
    for path in _as_list(paths):
        listed = spark.read.format("binaryFile").load(path).select("path", "length")
        files, file = listed.filter("length > 0"), ""
        while True:
            later = files.filter(F.col("path") > file).agg(F.min("path").alias("path"))
            file = later.first()["path"]
            if file is None:
                break
            row = spark.read.text(_GLOB_CHARACTERS.sub(r"\\\1", file)).select("value").first()
            if row is not None:
                return row["value"]
    raise ValueError(f"no lines in {paths}")


def strip_header(lines: DataFrame, header: str) -> DataFrame:
    """Drop every line that contains the header text, wherever it occurs."""
    return lines.filter(~F.col("value").contains(F.lit(header)))


def _fields() -> Column:
    # Trailing empty fields do not count: '1;2;;' has two fields.
    return F.split(F.rtrim(F.col("value"), F.lit(SEPARATOR)), SEPARATOR)


def split_fields(lines: DataFrame) -> DataFrame:
    """Add ``fields``, the line cut at every semicolon (no quoting or escapes)."""
    return lines.withColumn("fields", _fields())


def _width(text: str) -> int:
    return len(text.rstrip(SEPARATOR).split(SEPARATOR))


def _accepted(line: Column, numbers: Column) -> Column:
    # The pattern is only run on the rare line that holds a NaN or an infinity.
    special = F.lit(False)
    for value in ("NaN", "Infinity", "-Infinity"):
        held = F.coalesce(F.array_contains(numbers, F.lit(float(value))), F.lit(False))
        special = special | held
    return ~(special & line.rlike(_BAD_SPECIAL))


def _examples(parsed: DataFrame) -> DataFrame:
    numbers = F.col("numbers")
    return parsed.select(
        F.element_at(numbers, -1).alias("label"),
        array_to_vector(F.slice(numbers, 1, F.size(numbers) - 1)).alias("features"),
    )


def _holds_null(numbers: Column) -> Column:
    # Nulls sort first; unlike a lambda this stays in generated code.
    return F.get(F.sort_array(numbers), F.lit(0)).isNull()


def _lenient(lines: DataFrame, width: int | None) -> DataFrame:
    numbers = F.col("fields").try_cast("array<double>")
    parsed = split_fields(lines).withColumn("numbers", numbers)
    good = ~_holds_null(F.col("numbers")) & _accepted(F.col("value"), F.col("numbers"))
    if width is not None:
        good = good & (F.size("fields") == width)
    return parsed.withColumn("good", settled(good))


def parse_labelled(lines: DataFrame, width: int | None = None, strict: bool = True) -> DataFrame:
    """Lines to (``label``, ``features``): last field is the label, the rest the vector.

    Strict (the default) fails the job on any field that is not a number, and,
    with ``width`` given, on any line with another number of fields. With
    ``strict=False`` such lines are left out here; ``rejected_lines`` returns
    exactly those, so that both together are the whole input.
    """
    if not strict:
        return _examples(_lenient(lines, width).filter("good"))
    fields = split_fields(lines)
    parsed = fields.withColumn("numbers", F.col("fields").cast("array<double>"))
    accepted = _accepted(F.col("value"), F.col("numbers"))
    if str(lines.sparkSession.conf.get("spark.sql.ansi.enabled")).lower() != "true":
        # Here the cast itself does not fail but leaves nulls behind.
        accepted = accepted & ~_holds_null(F.col("numbers"))
    refused = F.raise_error(F.concat(F.lit("not a number in: "), F.col("value")))
    good = F.when(accepted, F.lit(True)).otherwise(refused)
    if width is not None:
        wrong = F.raise_error(F.concat(F.lit(f"expected {width} fields: "), F.col("value")))
        good = F.when(F.size("fields") == width, good).otherwise(wrong)
    # As a filter the check outlives pruning: counting the examples fails as well.
    return _examples(parsed.withColumn("good", settled(good)).filter("good"))


def rejected_lines(lines: DataFrame, width: int | None = None) -> DataFrame:
    """The lines that ``parse_labelled(..., strict=False)`` leaves out."""
    return _lenient(lines, width).filter("NOT good").select("value")


def sift(lines: DataFrame, width: int | None = None) -> DataFrame:
    """One row a line: (``label``, ``features``) of an example, or ``rejected``, the line itself.

    Examples and rejects of one scan: keep the frame, write ``rejects_of`` it, and
    work on ``examples_of`` it. Lines are accepted as by ``parse_labelled(..., strict=False)``.
    """
    numbers, good = F.col("numbers"), F.col("good")
    vector = array_to_vector(F.slice(numbers, 1, F.size(numbers) - 1))
    return _lenient(lines, width).select(
        F.when(good, F.element_at(numbers, -1)).alias("label"),
        F.when(good, vector).alias("features"),
        F.when(~good, F.col("value")).alias("rejected"),
    )


def examples_of(sifted: DataFrame) -> DataFrame:
    return sifted.filter("rejected IS NULL").select("label", "features")


def rejects_of(sifted: DataFrame) -> DataFrame:
    return sifted.filter("rejected IS NOT NULL").select(F.col("rejected").alias("value"))


def load_sifted(
    spark: SparkSession,
    paths: str | Sequence[str],
    header: str | None = None,
    strict_width: bool = False,
) -> DataFrame:
    """Read files, remove the header and sift the lines."""
    if header is None:
        header = probe_header(spark, paths)
    lines = strip_header(read_lines(spark, paths), header)
    return sift(lines, _width(header) if strict_width else None)


def load_labelled(
    spark: SparkSession,
    paths: str | Sequence[str],
    header: str | None = None,
    strict: bool = True,
    strict_width: bool = False,
) -> DataFrame:
    """Read files, remove the header and parse. Pass ``header`` to skip the probe."""
    if header is None:
        header = probe_header(spark, paths)
    lines = strip_header(read_lines(spark, paths), header)
    return parse_labelled(lines, width=_width(header) if strict_width else None, strict=strict)
