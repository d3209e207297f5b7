"""Running totals in an order, whatever the size of a group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from featherline.workspace import written


def running(df: DataFrame, by: Sequence[str], order: Sequence[Column], totals: Mapping[str, Column],
            ranges: int | None = None) -> DataFrame:
    """Add the running sum of each of ``totals`` within ``by``, in ``order``, the row itself included.

    ``by`` and ``order`` together should tell rows apart. Rows are range-partitioned on both, so a
    group of any size spreads over tasks; each range adds what the earlier ranges of its group sum
    to. Without a number of ``ranges`` there are as many as the session has shuffle partitions, less those
    that adaptive execution joins because they hold few bytes.
    """
    keys = [*[F.col(c) for c in by], *order]
    dealt = df.repartitionByRange(*keys) if ranges is None else df.repartitionByRange(ranges, *keys)
    # Range bounds are sampled, so the ranges are written down before they are used twice.
    ranged = written(dealt.withColumn("_range", F.spark_partition_id()), "ranges")
    sums = ranged.groupBy("_range", *by).agg(*[F.sum(v).alias(f"_before_{n}") for n, v in totals.items()])
    earlier = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        F.col("_range").alias("_range2"), *[F.col(c).alias(f"_by_{c}") for c in by],
        *[F.coalesce(F.sum(f"_before_{n}").over(earlier), F.lit(0)).alias(f"_before_{n}") for n in totals])
    inside = Window.partitionBy("_range", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = ranged.withColumns({name: F.sum(value).over(inside) for name, value in totals.items()})
    same = F.col("_range") == F.col("_range2")
    for column in by:
        same = same & F.col(column).eqNullSafe(F.col(f"_by_{column}"))
    # Without groups there is one offset per range, so the table is as small as the number of tasks.
    joined = summed.join(offsets if by else F.broadcast(offsets), same)
    return joined.select(
        *df.columns, *[(F.col(name) + F.col(f"_before_{name}")).alias(name) for name in totals])
