"""Ranking metrics per query, and training pairs that grow with the rows and not with their pairs."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from featherline.operators.ordered import running
from featherline.operators.tables import join_table


def parse_metric(text: str) -> tuple[str, int | None, bool]:
    """``ndcg@5-`` as (``ndcg``, 5, True): name, cut and whether a list without positives counts 0."""
    match = re.fullmatch(r"(ndcg|map)(?:@(\d+))?(-?)", text)
    if not match:
        raise ValueError(f"unknown ranking metric {text}")
    return match[1], int(match[2]) if match[2] else None, match[3] == "-"


def per_query(df: DataFrame, query: str, label: str, score: str, key: str, cut: int | None = None,
              empty_is_zero: bool = False, ranges: int | None = None) -> DataFrame:
    """NDCG and average precision of each query's list, ordered by score, then by ``key``.

    Without a cut, ranks are running counts, so a query with a third of all rows is ranked by many tasks.
    With one, only the first rows of a query in either order count, and tasks leave out the others
    before the shuffle.
    """
    one = F.lit(1)
    slim = df.select(query, F.col(label).cast("double").alias("_label"), F.col(score).alias("_score"), key)
    by_score, by_label = [F.col("_score").desc(), F.col(key)], [F.col("_label").desc(), F.col(key)]
    hit = (F.col("_label") > 0).cast("int")

    def gain(rank: str) -> Column:
        return F.sum((F.pow(F.lit(2.0), F.col("_label")) - 1) / F.log2(F.col(rank) + 1.0))

    precision = F.sum(F.when(F.col("_label") > 0, F.col("_hits") / F.col("_rank")).otherwise(0.0)).alias("_precision")
    counts = [F.count(one).alias("n_rows"), F.sum(hit).alias("_positives")]
    if cut is None:
        ranked = running(slim, [query], by_score, {"_rank": one, "_hits": hit}, ranges)
        ranked = running(ranked, [query], by_label, {"_ideal": one}, ranges)
        sums = ranked.groupBy(query).agg(*counts, gain("_rank").alias("_dcg"), gain("_ideal").alias("_best"), precision)
    else:
        def first(order: list[Column], rank: str) -> DataFrame:
            return slim.withColumn(rank, F.row_number().over(Window.partitionBy(query).orderBy(*order))).where(F.col(rank) <= cut)

        line = Window.partitionBy(query).orderBy("_rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        top = first(by_score, "_rank").withColumn("_hits", F.sum(hit).over(line))
        parts = [slim.groupBy(query).agg(*counts), top.groupBy(query).agg(gain("_rank").alias("_dcg"), precision),
                 first(by_label, "_ideal").groupBy(query).agg(gain("_ideal").alias("_best"))]
        sums = parts[0]
        for k, part in enumerate(parts[1:]):
            part = part.withColumnRenamed(query, f"_query{k}")
            sums = sums.join(part, F.col(query).eqNullSafe(F.col(f"_query{k}"))).drop(f"_query{k}")
    empty = F.lit(0.0 if empty_is_zero else 1.0)
    return sums.select(
        query, "n_rows",
        F.when(F.col("_best") == 0, empty).otherwise(F.col("_dcg") / F.col("_best")).alias("ndcg"),
        F.when(F.col("_positives") == 0, empty).otherwise(F.col("_precision") / F.col("_positives")).alias("map"))


def ranking_metric(df: DataFrame, metric: str, query: str, label: str, score: str, key: str,
                   ranges: int | None = None) -> DataFrame:
    """Mean over queries of a metric such as ``ndcg``, ``map@10`` or ``ndcg@5-``."""
    name, cut, empty_is_zero = parse_metric(metric)
    lists = per_query(df, query, label, score, key, cut, empty_is_zero, ranges)
    return lists.agg(F.avg(name).alias(metric))


def training_pairs(df: DataFrame, query: str, label: str, key: str, columns: Sequence[str],
                   pool_rows: int = 1000) -> DataFrame:
    """One less relevant partner per row, from the same query.

    Each query is split by hash into pools of about ``pool_rows`` rows, so a query of any size is
    many small groups. ``key`` must tell rows apart. In a pool, rows are ordered by label and hash; a
    row with ``k`` rows of lower label takes the one of them its hash points at. The rows are shuffled once: pools are
    numbered, gathered and paired by the same partitioning. The result has a row per pair: ``query``, the two
    keys and, for each of ``columns``, its values as ``<name>_high`` and ``<name>_low``.
    """
    if pool_rows < 2:
        raise ValueError("a pool needs at least 2 rows")
    digest = F.md5(F.concat_ws("|", F.col(query).cast("string"), F.col(key).cast("string")))
    number = {name: F.conv(F.substring(digest, at, 8), 16, 10).cast("long") for name, at in (("_slot", 1), ("_spin", 9))}
    # Pools per query from its size, counted with partial sums.
    sizes = df.groupBy(query).agg(F.ceil(F.count(F.lit(1)) / pool_rows).alias("_pools"))
    taken = F.struct(F.col(key).alias("key"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)])
    hashed = df.select(query, F.col(label).alias("_label"), taken.alias("_row"), digest.alias("_digest"),
                       number["_slot"].alias("_slot"), number["_spin"].alias("_spin"))
    pooled = join_table(hashed, sizes, [query]).withColumn("_pool", F.col("_slot") % F.col("_pools"))
    lower = F.rank().over(Window.partitionBy(query, "_pool").orderBy("_label")) - 1
    member = F.struct("_label", "_digest", F.col("_row.key").alias("key"), "_lower", "_spin", "_row")
    pools = pooled.withColumn("_lower", lower).groupBy(query, "_pool").agg(F.sort_array(F.collect_list(member)).alias("_rows"))
    rows = F.col("_rows")
    pairs = F.transform(
        F.filter(rows, lambda r: r["_lower"] > 0),
        lambda r: F.struct(r["_row"].alias("high"), F.get(rows, (r["_spin"] % r["_lower"]).cast("int"))["_row"].alias("low")))
    exploded = pools.select(query, F.explode(pairs).alias("_pair"))
    sides = [F.col(f"_pair.{side}.key").alias(f"{key}_{side}") for side in ("high", "low")]
    sides += [F.col(f"_pair.{side}.c{i}").alias(f"{c}_{side}") for i, c in enumerate(columns) for side in ("high", "low")]
    return exploded.select(query, *sides)
