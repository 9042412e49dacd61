"""The two whole runs: train and validate, and score with saved models."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.ml import Transformer
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tallyframe import catalog
from tallyframe.catalog import ALL_KINDS, ModelKind
from tallyframe.operators.evaluation import accuracy_of, accuracy_summary
from tallyframe.operators.reports import comparison_report, model_report, write_report
from tallyframe.operators.scoring import score_all
from tallyframe.operators.training import bounded_partitions, fit_all, worth_keeping
from tallyframe.sources.delimited import examples_of, load_labelled, load_sifted, rejects_of
from tallyframe.sources.fit_records import FitRecord, input_state, read_record, write_record
from tallyframe.sources.saved_models import load_model, load_models, model_path, save_model
from tallyframe.storage import path_exists, refuse_existing

_CACHE = StorageLevel.MEMORY_AND_DISK


class TooManyRejects(ValueError):
    """A source holds more lines that are no examples than the run may leave out."""


@dataclass(frozen=True)
class RunResult:
    """``report`` and ``summary`` are lazy unless a report path was given.

    ``rejects`` has, for each source that was sifted, its number of lines (the
    header apart) and of rejected ones. ``resumed`` are the models, by key, that
    an earlier run had fitted.
    """

    models: dict[str, Transformer]
    report: DataFrame
    summary: DataFrame
    rejects: dict[str, dict[str, int]] = field(default_factory=dict)
    resumed: tuple[str, ...] = ()


@dataclass(frozen=True)
class Rejects:
    """Where rejected lines of a run go, ``<path>/<source>``, and how many a source may have."""

    path: str
    most: int | None = None
    overwrite: bool = False

    def place(self, source: str) -> str:
        return f"{self.path.rstrip('/')}/{source}"


def _rejects(path: str | None, most: int | None, overwrite: bool = False) -> Rejects | None:
    if path is None:
        if most is not None:
            raise ValueError("a limit of rejects needs a path for them")
        return None
    return Rejects(path, most, overwrite)


@contextmanager
def _examples(
    spark: SparkSession,
    source: str,
    paths: str | Sequence[str],
    header: str | None,
    strict_width: bool,
    rejects: Rejects | None,
    keep: bool,
    max_partitions: int | None = None,
) -> Iterator[tuple[DataFrame, dict[str, int] | None]]:
    """The examples of a source, kept or not, and how many lines were rejected if they may be.

    Rejects are written first, from the same kept rows that the examples come
    from, so the text is scanned once; the lines are counted by that write. Too
    many of them end the run before any model is fitted or applied.
    """
    if rejects is None:
        kept = bounded_partitions(
            load_labelled(spark, paths, header, strict_width=strict_width), max_partitions
        )
        if keep:
            kept.persist(_CACHE)
        found, counts = kept, None
    else:
        kept = bounded_partitions(load_sifted(spark, paths, header, strict_width), max_partitions)
        if keep:
            kept.persist(_CACHE)
        found, counts = examples_of(kept), {}
    try:
        if rejects is not None:
            watch = Observation(f"lines-{source}")
            seen = kept.observe(
                watch, F.count("*").alias("lines"), F.count("rejected").alias("rejected")
            )
            mode = "overwrite" if rejects.overwrite else "errorifexists"
            rejects_of(seen).write.mode(mode).text(rejects.place(source))
            counts = {name: int(watch.get[name]) for name in ("lines", "rejected")}
            if rejects.most is not None and counts["rejected"] > rejects.most:
                raise TooManyRejects(
                    f"{counts['rejected']} of {counts['lines']} {source} lines are no examples, "
                    f"at most {rejects.most} may be; they are in {rejects.place(source)}"
                )
        yield found, counts
    finally:
        if keep:
            kept.unpersist()


def _in_order(kinds: Iterable[ModelKind]) -> list[ModelKind]:
    return sorted(kinds, key=ALL_KINDS.index)


def _report(scored: DataFrame, kinds: list[ModelKind], training: bool) -> DataFrame:
    if len(kinds) == 1:
        return model_report(scored, kinds[0], kinds[0].score_column, training)
    return comparison_report(scored, kinds)


def _evaluate(
    spark: SparkSession,
    test: DataFrame,
    models: Mapping[str, Transformer],
    kinds: list[ModelKind],
    report_path: str | None,
    training: bool,
    overwrite: bool = False,
) -> tuple[DataFrame, DataFrame]:
    scored = score_all(test, models)
    if report_path is None:
        return _report(scored, kinds, training), accuracy_summary(scored, kinds)
    # The accuracies are counted while the report is written, so the test set
    # is read and scored once. There is no shuffle: each task counts once.
    watch = Observation("accuracy")
    watched = scored.observe(watch, *[accuracy_of(k.score_column).alias(k.key) for k in kinds])
    write_report(_report(watched, kinds, training), report_path, overwrite)
    seen = watch.get
    summary = spark.createDataFrame(
        [(k.title, float(seen[k.key])) for k in kinds], "model string, accuracy double"
    )
    return spark.read.parquet(report_path), summary


def _record_of(
    kind: ModelKind,
    options: Mapping[str, Mapping[str, float]] | None,
    state: Mapping[str, object],
    **settings: object,
) -> FitRecord:
    fixed = {
        name: value
        for name, value in vars(catalog).items()
        if name.isupper() and isinstance(value, int | float | str)
    }
    own = dict((options or {}).get(kind.key, {}))
    return FitRecord.of({**fixed, **settings, "model": kind.key, "options": own}, state)


def _finished(
    spark: SparkSession, wanted: Mapping[ModelKind, tuple[str, FitRecord]], overwrite: bool
) -> dict[str, Transformer]:
    """The models that were fitted as is wanted now. Others than wanted are an error, unless overwritten."""
    models = {}
    for kind, (path, record) in wanted.items():
        there = read_record(spark, path)
        if there == record:
            models[kind.key] = load_model(path, kind)
        elif there is not None and not overwrite:
            raise ValueError(
                f"the model in {path} was fitted otherwise: {', '.join(record.unlike(there))}"
            )
    return models


def _refuse_report(spark: SparkSession, path: str, resume: bool) -> None:
    """An existing report is refused; when a run is resumed, only one that was written to its end."""
    if not resume or path_exists(spark, f"{path.rstrip('/')}/_SUCCESS"):
        refuse_existing(spark, path)


def train_and_validate(
    spark: SparkSession,
    training_paths: str | Sequence[str],
    validation_paths: str | Sequence[str],
    kinds: Iterable[ModelKind] = ALL_KINDS,
    model_directory: str | None = None,
    report_path: str | None = None,
    overwrite_models: bool = False,
    max_partitions: int | None = None,
    strict_width: bool = False,
    parallelism: int = 1,
    header: str | None = None,
    keep: bool | None = None,
    options: Mapping[str, Mapping[str, float]] | None = None,
    resume: bool = False,
    rejects_path: str | None = None,
    max_rejects: int | None = None,
) -> RunResult:
    """Fit every kind on one set, score the other, report, and save the models.

    Paths that exist already are refused before anything is read, and each model
    is saved as its fit ends. ``header`` is the header line of both sets, if it is
    known. ``keep`` tells whether the parsed examples are persisted; by default
    they are if the fits make more than two passes. ``options`` go to single
    fits, as ``{"logistic": {"iterations": 20, "tolerance": 1e-4}}``.

    ``resume`` takes up a run that failed: models in ``model_directory`` that were
    saved whole, with the same settings and from the same files, are loaded
    instead of fitted; what a failed save or report has left is written anew,
    and so are rejects.
    Models fitted otherwise are an error, or fitted again with ``overwrite_models``.

    With ``rejects_path``, lines that are no examples do not fail the run but go
    to ``<rejects_path>/training`` and ``<rejects_path>/validation``; more than
    ``max_rejects`` in one source end it with ``TooManyRejects``.
    """
    kinds = _in_order(kinds)
    if resume and model_directory is None:
        raise ValueError("only a run with a model directory can be resumed")
    rejects = _rejects(rejects_path, max_rejects, overwrite=resume)
    if model_directory is not None and not (overwrite_models or resume):
        for kind in kinds:
            refuse_existing(spark, model_path(model_directory, kind))
    if report_path is not None:
        _refuse_report(spark, report_path, resume)
    if rejects is not None and not resume:
        for source in ("training", "validation"):
            refuse_existing(spark, rejects.place(source))
    wanted, models = {}, {}
    if model_directory is not None:
        state = input_state(spark, training_paths)
        settings = {"header": header, "strict_width": strict_width, "max_partitions": max_partitions}
        settings |= {"rejects": rejects is not None, "spark": spark.version}
        wanted = {
            kind: (model_path(model_directory, kind), _record_of(kind, options, state, **settings))
            for kind in kinds
        }
        if resume:
            models = _finished(spark, wanted, overwrite_models)
    resumed = tuple(models)
    left = [kind for kind in kinds if kind.key not in models]

    def save(kind: ModelKind, model: Transformer) -> None:
        if kind in wanted:
            path, record = wanted[kind]
            save_model(model, path, overwrite_models or resume)
            write_record(spark, path, record)

    counts: dict[str, dict[str, int]] = {}
    if left:
        # The text is parsed once and kept for all fits. What a lost executor held
        # is parsed again from its own splits.
        held = worth_keeping(left) if keep is None else keep
        source = _examples(
            spark, "training", training_paths, header, strict_width, rejects, held, max_partitions
        )
        with source as (examples, seen):
            if seen is not None:
                counts["training"] = seen
            models |= fit_all(examples, left, parallelism, options, save)
    models = {kind.key: models[kind.key] for kind in kinds}
    return _scored_run(
        spark, "validation", validation_paths, header, strict_width, rejects, models, kinds,
        report_path, True, counts, resumed, resume,
    )


def _scored_run(
    spark: SparkSession,
    source: str,
    paths: str | Sequence[str],
    header: str | None,
    strict_width: bool,
    rejects: Rejects | None,
    models: dict[str, Transformer],
    kinds: list[ModelKind],
    report_path: str | None,
    training: bool,
    counts: dict[str, dict[str, int]],
    resumed: tuple[str, ...] = (),
    overwrite: bool = False,
) -> RunResult:
    # A lazy report reads the text when it is asked for; a written one shares its scan with the rejects.
    keep = rejects is not None and report_path is not None
    with _examples(spark, source, paths, header, strict_width, rejects, keep) as (test, seen):
        if seen is not None:
            counts[source] = seen
        report, summary = _evaluate(spark, test, models, kinds, report_path, training, overwrite)
    return RunResult(models, report, summary, counts, resumed)


def score_saved(
    spark: SparkSession,
    testing_paths: str | Sequence[str],
    model_directory: str,
    kinds: Iterable[ModelKind] = ALL_KINDS,
    report_path: str | None = None,
    strict_width: bool = False,
    header: str | None = None,
    rejects_path: str | None = None,
    max_rejects: int | None = None,
) -> RunResult:
    """Load models, score one set with all of them, and report.

    With ``rejects_path``, lines that are no examples go to ``<rejects_path>/testing``.
    """
    kinds = _in_order(kinds)
    rejects = _rejects(rejects_path, max_rejects)
    if report_path is not None:
        refuse_existing(spark, report_path)
    if rejects is not None:
        refuse_existing(spark, rejects.place("testing"))
    models = load_models(model_directory, kinds)
    return _scored_run(
        spark, "testing", testing_paths, header, strict_width, rejects, models, kinds,
        report_path, False, {},
    )
