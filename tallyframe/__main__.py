"""Command line, for ``spark-submit`` or ``python -m tallyframe``.

    train   --training PATH --validation PATH [--models DIR] [--report PATH]
    predict --testing PATH --models DIR [--report PATH]

``--resume`` takes up a training run that failed, and ``--rejects`` takes lines
that are no examples instead of failing. ``--kind`` (repeatable) picks single models; the default is all four. The
master and all sizing come from the submitter.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tallyframe.catalog import ALL_KINDS, LOGISTIC, kind_of
from tallyframe.operators.evaluation import accuracy_lines
from tallyframe.plans.runs import RunResult, score_saved, train_and_validate


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tallyframe")
    commands = parser.add_subparsers(dest="command", required=True)
    train = commands.add_parser("train")
    train.add_argument("--training", nargs="+", required=True)
    train.add_argument("--validation", nargs="+", required=True)
    train.add_argument("--models")
    train.add_argument("--overwrite", action="store_true")
    train.add_argument("--resume", action="store_true", help="keep the models already fitted")
    train.add_argument("--max-partitions", type=int)
    train.add_argument("--parallelism", type=int, default=1)
    train.add_argument("--iterations", type=int, help="of logistic regression, at most")
    train.add_argument("--tolerance", type=float, help="of logistic regression")
    predict = commands.add_parser("predict")
    predict.add_argument("--testing", nargs="+", required=True)
    predict.add_argument("--models", required=True)
    for command in (train, predict):
        command.add_argument("--kind", action="append", choices=[k.key for k in ALL_KINDS])
        command.add_argument("--report")
        command.add_argument("--strict-width", action="store_true")
        command.add_argument("--rejects", help="where lines go that are no examples")
        command.add_argument("--max-rejects", type=int, help="of one source, else the run ends")
        command.add_argument("--dataset-name")
        command.add_argument("--header", help="the header line, if it is known")
    return parser.parse_args(argv)


def _print(result: RunResult, dataset: str | None) -> None:
    result.report.show()
    for row in accuracy_lines(result.summary, dataset).collect():
        print(row["line"])
    for source, seen in result.rejects.items():
        print(f"Rejected {seen['rejected']} of {seen['lines']} {source} lines")


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    spark = SparkSession.builder.appName("tallyframe").getOrCreate()
    kinds = ALL_KINDS if not args.kind else [kind_of(key) for key in args.kind]
    if args.command == "train":
        given = {"iterations": args.iterations, "tolerance": args.tolerance}
        logistic = {name: value for name, value in given.items() if value is not None}
        result = train_and_validate(
            spark,
            args.training,
            args.validation,
            kinds,
            model_directory=args.models,
            report_path=args.report,
            overwrite_models=args.overwrite,
            max_partitions=args.max_partitions,
            parallelism=args.parallelism,
            header=args.header,
            options={LOGISTIC.key: logistic},
            strict_width=args.strict_width,
            resume=args.resume,
            rejects_path=args.rejects,
            max_rejects=args.max_rejects,
        )
    else:
        result = score_saved(
            spark,
            args.testing,
            args.models,
            kinds,
            report_path=args.report,
            strict_width=args.strict_width,
            header=args.header,
            rejects_path=args.rejects,
            max_rejects=args.max_rejects,
        )
    _print(result, args.dataset_name)


if __name__ == "__main__":
    main()
