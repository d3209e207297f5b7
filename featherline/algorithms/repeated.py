"""Rows that repeat, taken as one row with a weight: a fit then goes over the distinct ones, however often each occurs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: Most distinct rows, and times that a row occurs on average at least, for which a table is gathered.
DISTINCT, TIMES = 2_000_000, 4


def gathered(df: DataFrame, keys: Sequence[str], weight: str, least: int = 0, **sums: Column) -> DataFrame | None:
    """The distinct ``keys`` with their number of rows as ``weight`` and the named sums; nothing where too few rows repeat, or where there are ``least`` or fewer.

    One pass estimates how many are distinct, a second one counts each, partly before the shuffle.
    """
    rows, distinct = df.agg(F.count(F.lit(1)), F.approx_count_distinct(F.xxhash64(*[plain(df, k) for k in keys]))).first()
    if rows <= least or distinct > DISTINCT or distinct * TIMES > rows:
        return None
    return df.groupBy(*keys).agg(F.count(F.lit(1)).cast("double").alias(weight), *[F.sum(x).alias(name) for name, x in sums.items()])


def plain(df: DataFrame, name: str) -> Column:
    """A column that hashes: a vector as its struct."""
    return F.unwrap_udt(F.col(name)) if hasattr(df.schema[name].dataType, "sqlType") else F.col(name)
