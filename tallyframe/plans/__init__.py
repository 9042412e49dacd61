from tallyframe.plans.runs import RunResult, TooManyRejects, score_saved, train_and_validate

__all__ = ["RunResult", "TooManyRejects", "score_saved", "train_and_validate"]
