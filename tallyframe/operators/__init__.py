from tallyframe.operators.evaluation import (
    accuracy,
    accuracy_lines,
    accuracy_metrics,
    accuracy_summary,
    correct_rows,
    error_rate,
    wrong_rows,
)
from tallyframe.operators.reports import (
    comparison_report,
    model_report,
    plain_report,
    preview,
    write_report,
)
from tallyframe.operators.scoring import prediction_pairs, score, score_all
from tallyframe.operators.training import (
    bounded_partitions,
    fit,
    fit_all,
    fit_bayes,
    fit_forest,
    fit_logistic,
    fit_tree,
)

__all__ = [
    "accuracy",
    "accuracy_lines",
    "accuracy_metrics",
    "accuracy_summary",
    "bounded_partitions",
    "comparison_report",
    "correct_rows",
    "error_rate",
    "fit",
    "fit_all",
    "fit_bayes",
    "fit_forest",
    "fit_logistic",
    "fit_tree",
    "model_report",
    "plain_report",
    "prediction_pairs",
    "preview",
    "score",
    "score_all",
    "write_report",
    "wrong_rows",
]
