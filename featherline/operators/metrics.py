"""Quality of predictions, each table of metrics in one aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from featherline.operators import losses


def ratio(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / whole)


def f_score(precision: Column, recall: Column, beta: float) -> Column:
    square = beta * beta
    return ratio((1 + square) * precision * recall, square * precision + recall)


def clustering_loss(df: DataFrame, distance: str = "distance_to_cluster") -> DataFrame:
    """``msd`` and ``ssd``: mean and sum of the squared distance to the closest center."""
    squared = F.col(distance) * F.col(distance)
    return df.agg(F.avg(squared).alias("msd"), F.sum(squared).alias("ssd"))


def confusion(df: DataFrame, label: str, positive: Column) -> DataFrame:
    """Counts of true and false positives and negatives."""
    is_one = F.col(label) == 1
    return df.agg(
        F.count_if(is_one & positive).alias("tp"), F.count_if(~is_one & positive).alias("fp"),
        F.count_if(is_one & ~positive).alias("fn"), F.count_if(~is_one & ~positive).alias("tn"))


def rates(counts: DataFrame, beta: float = 1.0) -> DataFrame:
    """Accuracy, error, precision, recall, F1 and F-beta beside ``tp, fp, fn, tn``."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    total = tp + fp + fn + tn
    precision, recall = F.col("precision"), F.col("recall")
    return counts.withColumns({
        "accuracy": ratio(tp + tn, total), "error": ratio(fp + fn, total),
        "precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn),
    }).withColumns({"f1": f_score(precision, recall, 1.0), "f_beta": f_score(precision, recall, beta)})


def binary_metrics(df: DataFrame, label: str = "label", score: str = "score", threshold: float = 0.5,
                   beta: float = 1.0) -> DataFrame:
    """Metrics of the decision ``score >= threshold``, which is how models and chosen thresholds decide."""
    return rates(confusion(df, label, F.col(score) >= threshold), beta)


def errors_at(df: DataFrame, thresholds: Sequence[float], label: str = "label", score: str = "score") -> DataFrame:
    """``error@t`` for each threshold: one pass with a sum per threshold."""
    wrong = [((F.col(score) > t) != (F.col(label) == 1)).cast("double") for t in thresholds]
    sums = df.agg(*[F.avg(w).alias(f"e{i}") for i, w in enumerate(wrong)])
    rows = F.array(*[F.struct(F.lit(float(t)).alias("threshold"), F.col(f"e{i}").alias("error")) for i, t in enumerate(thresholds)])
    return sums.select(F.inline(rows))


def multiclass_metrics(df: DataFrame, label: str = "label", predicted: str = "predicted_label") -> DataFrame:
    wrong = F.avg(F.when(F.col(label) == F.col(predicted), 0.0).otherwise(1.0))
    return df.agg((1 - wrong).alias("accuracy"), wrong.alias("merror"))


def regression_errors(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    error = F.col(label) - F.col(score)
    return df.agg(F.sqrt(F.avg(error * error)).alias("rmse"), F.avg(F.abs(error)).alias("mae"))


def log_losses(df: DataFrame, label: str = "label", probability: str = "score") -> DataFrame:
    return df.agg(F.avg(losses.log_loss(F.col(label), F.col(probability))).alias("logloss"))


def multiclass_log_losses(df: DataFrame, label: str = "label", probabilities: str = "score") -> DataFrame:
    return df.agg(F.avg(losses.multiclass_log_loss(F.col(label), F.col(probabilities))).alias("mlogloss"))


def in_top_k(label: Column, scores: Column, k: int) -> Column:
    """Whether fewer than ``k`` classes beat the true one; equal scores go to the lower class."""
    if k < 1:
        raise ValueError("k must be at least 1")
    own = F.get(scores, label.cast("int"))
    better = F.filter(scores, lambda s, i: (s > own) | ((s == own) & (i < label)))
    return F.size(better) < k


def top_k_accuracy(df: DataFrame, k: int = 3, label: str = "label", scores: str = "score") -> DataFrame:
    hit = in_top_k(F.col(label), F.col(scores), k)
    return df.agg(F.avg(hit.cast("double")).alias("top_k_accuracy"))
