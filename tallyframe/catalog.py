"""Fixed values shared by the whole package.

The numbers, column names and directory names below are part of the results
(reports and saved models), so they are stated here once, as plain text.
"""

from __future__ import annotations

from dataclasses import dataclass

# Training settings.
NUM_CLASSES = 10
TREE_IMPURITY = "gini"
TREE_DEPTH = 5
TREE_BINS = 32
TREE_SEED = 0
FOREST_TREES = 9
FOREST_SUBSET = "auto"
FOREST_SEED = 12345
BAYES_SMOOTHING = 1.0
LOGISTIC_ITERATIONS = 100
LOGISTIC_TOLERANCE = 1e-6

# Report columns common to every report.
FEATURES_COLUMN = "Features"
LABEL_COLUMN = "Actual Label"


@dataclass(frozen=True)
class ModelKind:
    """One of the four classifiers, with the names it goes by."""

    key: str
    title: str
    training_column: str
    prediction_column: str
    directory: str

    @property
    def score_column(self) -> str:
        """Name of this model's prediction when several models score one frame."""
        return f"{self.key}_prediction"


# Names per model. "Naive Bayes " ends in a space on purpose.
LOGISTIC = ModelKind(
    key="logistic",
    title="Logistic Regression",
    training_column="Logistic Regression Prediction",
    prediction_column="Logistic Reg",
    directory="logisticRegressionModel",
)
TREE = ModelKind(
    key="tree",
    title="Decision Tree",
    training_column="Decision Tree Prediction",
    prediction_column="DecisionTree",
    directory="decisionTreeModel",
)
BAYES = ModelKind(
    key="bayes",
    title="Naive Bayes",
    training_column="Naive Bayes Prediction",
    prediction_column="Naive Bayes ",
    directory="naiveBayesModel",
)
FOREST = ModelKind(
    key="forest",
    title="Random Forest",
    training_column="Random Forest Prediction",
    prediction_column="RandomForest",
    directory="randomForestModel",
)

# The order of report columns and of the accuracy summary.
ALL_KINDS = (LOGISTIC, TREE, BAYES, FOREST)


def kind_of(key: str) -> ModelKind:
    for kind in ALL_KINDS:
        if kind.key == key:
            return kind
    raise ValueError(f"unknown model '{key}', expected one of {[k.key for k in ALL_KINDS]}")
