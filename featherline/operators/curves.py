"""Metrics over all thresholds of a score: calibration and area under the curve."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from featherline.operators import metrics
from featherline.operators.ordered import running
from featherline.operators.sampling import hash_sample
from featherline.workspace import written

# Ways to choose the threshold of a binary classifier (fixed values).
CRITERIA = ("accuracy", "f1", "f_beta", "precision_at_target_recall", "recall_at_target_precision",
            "cross_entropy_loss", "loss_function")


def by_score(df: DataFrame, label: str, score: str) -> DataFrame:
    """Positives and negatives per distinct score; a score many rows share becomes one row.

    A row without a score has no place among thresholds and is left out.
    """
    is_one = F.col(label) == 1
    counted = df.where(F.col(score).isNotNull()).groupBy(F.col(score).alias("threshold")).agg(
        F.count_if(is_one).alias("positives"), F.count_if(~is_one).alias("negatives"))
    return written(counted, "scores")


def threshold_sweep(df: DataFrame, label: str = "label", score: str = "score", beta: float = 1.0,
                    max_rows: int | None = None, key: Sequence[str | Column] = (), ranges: int | None = None) -> DataFrame:
    """Metrics of ``score >= threshold`` for every distinct score, optionally over a hash sample."""
    if max_rows is not None:
        df = hash_sample(df, max_rows, *key)
    counted = by_score(df, label, score)
    positives, negatives = counted.agg(F.sum("positives"), F.sum("negatives")).first()
    above = running(counted, [], [F.col("threshold").desc()],
                    {"tp": F.col("positives"), "fp": F.col("negatives")}, ranges)
    counts = above.select(
        "threshold", "tp", "fp", (F.lit(positives or 0) - F.col("tp")).alias("fn"),
        (F.lit(negatives or 0) - F.col("fp")).alias("tn"))
    return metrics.rates(counts, beta)


def best_threshold(sweep: DataFrame, criterion: str = "accuracy", target_recall: float = 0.8,
                   target_precision: float = 0.8) -> DataFrame:
    """The sweep's best row by a criterion; among equals the highest threshold."""
    if criterion == "precision_at_target_recall":
        allowed, goal = sweep.filter(F.col("recall") >= target_recall), "precision"
    elif criterion == "recall_at_target_precision":
        allowed, goal = sweep.filter(F.col("precision") >= target_precision), "recall"
    elif criterion in ("accuracy", "f1", "f_beta"):
        allowed, goal = sweep, criterion
    else:
        raise ValueError(f"no threshold is chosen by {criterion}")
    return allowed.orderBy(F.col(goal).desc(), F.col("threshold").desc()).limit(1)


def auc(df: DataFrame, label: str = "label", score: str = "score", ranges: int | None = None) -> DataFrame:
    """Area under the ROC curve by trapezoids; rows of equal score share one.

    Null where one of the classes has no row.
    """
    above = running(by_score(df, label, score), [], [F.col("threshold").desc()], {"tp": F.col("positives")}, ranges)
    area = F.sum(F.col("negatives") * (F.col("tp") - F.col("positives") / 2))
    pairs = F.sum("positives").cast("double") * F.sum("negatives")
    return above.agg(F.when(pairs > 0, area / pairs).alias("auc"))
