"""What a saved model was fitted from, so that a run that failed can be taken up again.

The record lies in the model's own folder and is written after the model: it is
there if and only if the model was saved whole, and goes when the model is
overwritten.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tallyframe.storage import path_exists

_SHAPE = "settings string, input string"


@dataclass(frozen=True)
class FitRecord:
    """``settings`` and ``input`` of a fit, as text that is equal for equal fits."""

    settings: str
    input: str

    @classmethod
    def of(cls, settings: Mapping[str, object], state: Mapping[str, object]) -> FitRecord:
        return cls(json.dumps(settings, sort_keys=True), json.dumps(state, sort_keys=True))

    def unlike(self, other: FitRecord) -> list[str]:
        """Names of what differs."""
        names = []
        for mine, theirs in ((self.settings, other.settings), (self.input, other.input)):
            one, two = json.loads(mine), json.loads(theirs)
            names += [k for k in sorted({*one, *two}) if one.get(k) != two.get(k)]
        return names


def input_state(spark: SparkSession, paths: str | Sequence[str]) -> dict[str, object]:
    """Number, bytes and a fingerprint of the files of a source, from their listing alone.

    Files are told apart by path, length and time of change, in any order. One
    aggregate on the executors; no file is opened.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    files = spark.read.format("binaryFile").load(paths)
    mark = F.xxhash64("path", "length", "modificationTime")
    row = files.select("length", mark.alias("mark")).agg(
        F.count("*").alias("files"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
        F.coalesce(F.bit_xor("mark"), F.lit(0)).alias("marks"),
        F.coalesce(F.sum(F.pmod("mark", F.lit(2**31))), F.lit(0)).alias("sum"),
    )
    return row.first().asDict()


def _place(model_path: str) -> str:
    return f"{model_path.rstrip('/')}/fit"


def write_record(spark: SparkSession, model_path: str, record: FitRecord) -> None:
    rows = spark.createDataFrame([(record.settings, record.input)], _SHAPE)
    rows.coalesce(1).write.mode("overwrite").json(_place(model_path))


def read_record(spark: SparkSession, model_path: str) -> FitRecord | None:
    """The record beside a model; None if there is none, or no whole one."""
    if not path_exists(spark, _place(model_path)):
        return None
    row = spark.read.schema(_SHAPE).json(_place(model_path)).first()
    return None if row is None else FitRecord(row["settings"], row["input"])
