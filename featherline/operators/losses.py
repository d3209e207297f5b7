"""Losses of a score against a label, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

EPSILON = 1e-15


def clipped(probability: Column) -> Column:
    return F.least(F.greatest(probability, F.lit(EPSILON)), F.lit(1 - EPSILON))


def log_loss(label: Column, probability: Column) -> Column:
    """Cross entropy of a 0/1 label and the probability of 1."""
    return -F.log(clipped(F.when(label == 1, probability).otherwise(1 - probability)))


def multiclass_log_loss(label: Column, probabilities: Column) -> Column:
    return -F.log(clipped(F.get(probabilities, label.cast("int"))))


def logistic(label: Column, margin: Column) -> Column:
    """Logistic loss of a 0/1 label and a score in log-odds, safe for large scores."""
    signed = F.when(label == 1, margin).otherwise(-margin)
    return F.log1p(F.exp(-F.abs(signed))) + F.greatest(-signed, F.lit(0.0))


def hinge(label: Column, score: Column, margin: float = 1.0) -> Column:
    signed = F.when(label == 1, score).otherwise(-score)
    return F.greatest(F.lit(margin) - signed, F.lit(0.0))


def squared(label: Column, score: Column) -> Column:
    return (label - score) * (label - score)


def absolute(label: Column, score: Column) -> Column:
    return F.abs(label - score)


def insensitive_absolute(label: Column, score: Column, insensitivity: float = 0.01) -> Column:
    return F.greatest(F.abs(label - score) - insensitivity, F.lit(0.0))


def insensitive_squared(label: Column, score: Column, insensitivity: float = 0.01) -> Column:
    beyond = insensitive_absolute(label, score, insensitivity)
    return beyond * beyond


def quantile(label: Column, score: Column, level: float = 0.5) -> Column:
    error = label - score
    return F.greatest(F.lit(level) * error, F.lit(level - 1) * error)


def huber(label: Column, score: Column, delta: float = 1.0) -> Column:
    error = F.abs(label - score)
    return F.when(error <= delta, 0.5 * error * error).otherwise(delta * (error - 0.5 * delta))


def softmax(label: Column, scores: Column) -> Column:
    """Cross entropy of a class and an array of unnormalised scores."""
    highest = F.array_max(scores)
    total = F.aggregate(scores, F.lit(0.0), lambda acc, s: acc + F.exp(s - highest))
    return F.log(total) + highest - F.get(scores, label.cast("int"))


def regression_losses(df: DataFrame, label: str, score: str, insensitivity: float = 0.01, level: float = 0.5,
                      delta: float = 1.0) -> DataFrame:
    """Mean of every regression loss, in one pass."""
    y, s = F.col(label), F.col(score)
    return df.agg(
        F.avg(squared(y, s)).alias("squared_loss"),
        F.avg(absolute(y, s)).alias("absolute_loss"),
        F.avg(insensitive_squared(y, s, insensitivity)).alias("eps_insensitive_squared_loss"),
        F.avg(insensitive_absolute(y, s, insensitivity)).alias("eps_insensitive_absolute_loss"),
        F.avg(quantile(y, s, level)).alias("quantile_loss"),
        F.avg(huber(y, s, delta)).alias("huber_loss"),
    )


def classification_losses(df: DataFrame, label: str, score: str, margin: float = 1.0) -> DataFrame:
    """Mean logistic and hinge loss of a log-odds score, in one pass."""
    y, s = F.col(label), F.col(score)
    return df.agg(F.avg(logistic(y, s)).alias("logistic"), F.avg(hinge(y, s, margin)).alias("hinge_loss"))
