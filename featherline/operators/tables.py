"""Projection, column binding, checks of feature tables, and where predictions go."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, functions as F, types as T

from featherline.functions import vectors


def project(df: DataFrame, columns: Sequence[str] | None) -> DataFrame:
    """Only the named columns; none named keeps all."""
    return df.select(*columns) if columns else df


def bind(df: DataFrame, features: str, label: str | None = None) -> DataFrame:
    """Just the named columns, under the conventional names ``label`` and ``features``."""
    chosen = [] if label is None else [F.col(label).cast("double").alias("label")]
    return df.select(*chosen, F.col(features).alias("features"))


def append(df: DataFrame, predictions: Mapping[str, Column], keep_input: bool = True) -> DataFrame:
    """Input columns followed by the predictions, or the predictions alone."""
    if keep_input:
        return df.withColumns(dict(predictions))
    return df.select(*[column.alias(name) for name, column in predictions.items()])


def require_columns(schema: T.StructType, features: str, label: str | None = None) -> None:
    """The schema must hold a vector column and, when named, a double label."""
    names = schema.fieldNames()
    label_ok = label is None or (label in names and isinstance(schema[label].dataType, T.DoubleType))
    features_ok = features in names and isinstance(schema[features].dataType, VectorUDT)
    if not (label_ok and features_ok):
        wanted = f"a vector column {features}" + ("" if label is None else f" and a double column {label}")
        raise ValueError(f"{wanted} expected, got {schema.simpleString()}")


def _is_bad_number(x: Column) -> Column:
    return F.isnan(x) | (F.abs(x) == float("inf"))


def violations(df: DataFrame, features: str = "features", label: str | None = None,
               feature_dim: int | None = None, num_classes: int | None = None) -> DataFrame:
    """One row counting each kind of bad row, in a single pass.

    Labels must be numbers and, with ``num_classes``, whole and below it. Vectors must have
    ``feature_dim`` entries, all finite.
    """
    require_columns(df.schema, features, label)
    vector = F.col(features)
    checks = {
        "null_features": vector.isNull(),
        "nonfinite_features": F.exists(F.unwrap_udt(vector)["values"], _is_bad_number),
    }
    if feature_dim is not None:
        checks["wrong_size"] = vectors.vector_size(vector) != feature_dim
    if label is not None:
        target = F.col(label)
        checks["null_label"] = target.isNull()
        checks["nonfinite_label"] = _is_bad_number(target)
        if num_classes is not None:
            checks["label_out_of_range"] = (
                (target < 0) | (target >= num_classes) | (F.floor(target).cast("double") != target)
            )
    counts = [F.count_if(check).alias(name) for name, check in checks.items()]
    return df.agg(F.count(F.lit(1)).alias("n_rows"), *counts)


def require_valid(df: DataFrame, **arguments) -> None:
    """Fail when the table holds any bad row."""
    counts = violations(df, **arguments).first().asDict()
    bad = {name: n for name, n in counts.items() if name != "n_rows" and n}
    if bad:
        raise ValueError(f"bad rows in the feature table: {bad}")


def join_table(df: DataFrame, table: DataFrame, on: Sequence[str]) -> DataFrame:
    """Join a table of one row per key. Adaptive execution measures its bytes: a table below the session's
    broadcast threshold goes to every task, otherwise both sides shuffle and keys that are too large are split."""
    return df.join(table, list(on))


def first_rows(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """The first ``n`` rows in a given order, to be scored after the cut."""
    if not order:
        raise ValueError("an order is needed to say which rows come first")
    return df.orderBy(*order).limit(n)
