from collections import Counter

import numpy as np
import pytest

from tallyframe.functions import majority_vote


def winner(votes):
    counts = Counter(votes)
    return min(counts, key=lambda c: (-counts[c], c))


# (trees, classes): 9 x 10 fits one BIGINT, the last two do not.
@pytest.mark.parametrize("trees, classes", [(9, 10), (1, 1), (2, 3), (15, 15), (16, 13), (20, 40)])
def test_against_counting(spark, trees, classes):
    rng = np.random.default_rng(7)
    table = rng.integers(0, classes, size=(400, trees)).astype(float)
    columns = [f"v{i}" for i in range(trees)]
    rows = [(i, *map(float, row)) for i, row in enumerate(table)]
    frame = spark.createDataFrame(rows, ["id", *columns])
    voted = majority_vote(frame, columns, "winner", classes)
    assert voted.columns == ["id", "winner"]
    found = {row["id"]: row["winner"] for row in voted.collect()}
    assert found == {i: winner(list(row)) for i, row in enumerate(table)}


def test_unanimous_top_class(spark):
    frame = spark.createDataFrame([(9.0,) * 9], [f"v{i}" for i in range(9)])
    assert majority_vote(frame, frame.columns, "winner").first()["winner"] == 9.0


@pytest.mark.parametrize("votes", [(12.0, 12.0, 3.0), (-1.0, 1.0, 1.0), (0.5, 0.5, 1.0), (None, 1.0, 1.0)])
@pytest.mark.parametrize("classes", [10, 100])
def test_votes_outside_the_classes_fail(spark, votes, classes):
    if classes == 100 and votes[0] == 12.0:
        votes = (120.0, 120.0, 3.0)
    frame = spark.createDataFrame([votes], "a double, b double, c double")
    with pytest.raises(Exception, match="none of the classes|CAST"):
        majority_vote(frame, ["a", "b", "c"], "winner", classes).collect()
