"""Connected components of a graph given as edges, by alternating stars.

Each round links every node's larger neighbours to its smallest one, then its smaller neighbours to the
smallest of them, until every component is a star around its smallest node. A node may have any number
of neighbours: minima are summed up before the shuffle, and joins are between written tables, which
adaptive execution can split at a node that many edges share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from featherline.llm.tasks import staged


def _stars(pairs: DataFrame, only_larger: bool) -> DataFrame:
    """``a, b`` as edges seen from a: those b's (larger than a, or any) with the least of a's neighbours and a."""
    least = staged(pairs.groupBy(F.col("a").alias("_a")).agg(F.min("b").alias("_b")).select(
        "_a", F.least("_a", "_b").alias("_least")), "least")
    joined = pairs.join(least, F.col("a") == F.col("_a"))
    if only_larger:
        return joined.where("b > a").select(F.col("b").alias("high"), F.col("_least").alias("low"))
    return joined.select(F.col("b").alias("high"), F.col("_least").alias("low")).union(
        least.select(F.col("_a").alias("high"), F.col("_least").alias("low")))


def _settled(edges: DataFrame) -> bool:
    """Whether the edges are stars: every larger end has one edge, and none is a smaller end too."""
    ends = F.array(F.struct(F.col("high").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")),
                   F.struct(F.col("low").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    nodes = edges.select(F.inline(ends)).groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not nodes.agg(F.max((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0)))).first()[0]


def components(edges: DataFrame) -> DataFrame:
    """``id, component``: the least node reachable, for every node of the edges ``a, b``.

    Edges with a null or to the node itself say nothing and are left out; repeated ones count once.
    """
    current = staged(edges.where("a <> b").select(
        F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct(), "edges")
    while not _settled(current):
        both = current.select(F.col("high").alias("a"), F.col("low").alias("b")).union(
            current.select(F.col("low").alias("a"), F.col("high").alias("b")))
        large = staged(_stars(both, True).where("high <> low").distinct(), "large")
        down = large.select(F.col("high").alias("a"), F.col("low").alias("b"))
        current = staged(_stars(down, False).where("high <> low").distinct(), "small")
    return current.select(F.col("high").alias("id"), F.col("low").alias("component")).union(
        current.select("low", "low").distinct())
