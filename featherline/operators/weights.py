"""Feature moments and class weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from featherline.operators.sampling import hash_sample
from featherline.operators.tables import join_table


def moments(df: DataFrame, features: str = "features", label: str | None = None,
            max_rows: int | None = None, key: Sequence[str] = ()) -> DataFrame:
    """Mean and sample standard deviation of every feature and of the label, as one row.

    With ``max_rows``, over a hash-ordered sample of at most that many rows, told apart by ``key``.
    """
    if max_rows is not None:
        df = hash_sample(df, max_rows, *key)
    summary = Summarizer.metrics("mean", "std").summary(F.col(features))
    columns = [summary.alias("_summary"), F.count(F.lit(1)).alias("n_rows")]
    if label is not None:
        columns += [F.avg(label).alias("label_mean"), F.stddev_samp(label).alias("label_std")]
    extra = ["label_mean", "label_std"] if label is not None else []
    return df.agg(*columns).select(
        "n_rows", F.col("_summary.mean").alias("mean"), F.col("_summary.std").alias("std"), *extra)


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """One row per class: its size, and the weight that gives all classes the same total."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total, classes = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    weight = F.lit(float(total or 0)) / (F.lit(float(classes)) * F.col("n"))
    return counts.withColumn("weight", weight)


def positive_weight(df: DataFrame, label: str = "label", multiplier: float | str = 1.0) -> float:
    """Weight of positive rows: a number, or ``balanced`` for negatives over positives (``auto`` is searched for by the trainer)."""
    if multiplier != "balanced":
        return float(multiplier)
    positive, negative = df.agg(F.count_if(F.col(label) == 1), F.count_if(F.col(label) != 1)).first()
    return negative / positive if positive else 1.0


def positive_weight_column(label: Column, weight: float) -> Column:
    return F.when(label == 1, F.lit(float(weight))).otherwise(F.lit(1.0))


def with_class_weights(df: DataFrame, label: str = "label", weight: str = "weight") -> DataFrame:
    """Each row with its class's weight. Rows without a label have no class and are left out."""
    table = class_weights(df, label).select(label, F.col("weight").alias(weight))
    return join_table(df, table, [label])


def neg_over_pos(df: DataFrame, label: str = "label") -> DataFrame:
    return df.agg(
        F.count_if(F.col(label) == 1).alias("n_positive"),
        F.count_if(F.col(label) != 1).alias("n_negative"),
        (F.count_if(F.col(label) != 1) / F.count_if(F.col(label) == 1)).alias("ratio"))


