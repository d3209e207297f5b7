"""Approximate nearest neighbours: a vantage-point tree per shard.

Vectors are hashed into shards of about ``SHARD_ROWS``; each shard's tree is built by one task and is a row of a written table.
The queries are cut into blocks, and every block meets every shard's tree in a Cartesian product of partitions: tasks read the trees
where they were written, no block is copied for each of them, and a task carries a block's k best from tree to tree and tells them once. The metric is the chord
between unit vectors, which orders as the cosine does. A subtree is left out when the triangle
inequality puts it beyond the k-th distance found so far, divided by ``factor``: one is exact search,
more visits less. What is found is scored by the cosine of the original vectors in double precision.

Vectors that are null, zero or hold null or non-finite components take no part, nor do rows without an
id. Only vectors of equal length are compared. Candidates that repeat an id with the same vector count once;
a query's own id is never a candidate. Ties go to the smaller id. No query or no candidate gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from featherline.llm.tasks import tidy
from featherline.llm.vectors import cosine, matrix, packed, unit, usable
from featherline.workspace import written

SHARD_ROWS, QUERY_ROWS, LEAF_ROWS, FACTOR, SEED = 8192, 4096, 128, 1.0, 17
#: Blocks of queries that a task searches its trees for.
QUERY_BLOCKS = 4
#: What rounding may add to a chord that is compared with a bound.
SLACK = 1e-7


def build(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the rows, nodes and radii of a tree over unit vectors ``x``.

    A node (begin, end, left, right) holds the rows order[begin:end]; the first is its vantage point if
    it has children, whose distances from it lie within radii (left low, left high, right low, right high).
    """
    order = np.random.default_rng(SEED).permutation(len(x))
    nodes, radii, open_nodes = [[0, len(x), -1, -1]], [[0.0] * 4], [0]
    while open_nodes:
        at = open_nodes.pop()
        begin, end = nodes[at][:2]
        if end - begin <= LEAF_ROWS:
            continue
        inner = order[begin + 1:end]
        far = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (x[inner] @ x[order[begin]])))
        ranked = np.argsort(far, kind="stable")
        order[begin + 1:end] = inner[ranked]
        far = far[ranked]
        half = len(far) // 2
        nodes[at][2:] = [len(nodes), len(nodes) + 1]
        radii[at] = [far[0], far[half - 1], far[half], far[-1]]
        for a, b in ((begin + 1, begin + 1 + half), (begin + 1 + half, end)):
            open_nodes.append(len(nodes))
            nodes.append([a, b, -1, -1])
            radii.append([0.0] * 4)
    return order, np.array(nodes, np.int64), np.array(radii)


class Search:
    """The k nearest of a shard's rows for a block of queries, or of them and what an ``earlier`` search of the block found."""

    def __init__(self, ids, raw, nodes, radii, query_ids, query_raw, k, factor, x=None, earlier=None):
        self.ids, self.raw, self.x = ids, raw, unit(raw) if x is None else x
        self.nodes, self.radii, self.k, self.factor = nodes, radii, k, factor
        self.query_ids, self.query_raw, self.q = query_ids, query_raw, unit(query_raw)
        n = len(query_ids)
        self.best, self.best_ids = earlier or (np.full((n, k), -np.inf), np.full((n, k), np.iinfo(np.int64).max))
        self.visited = 0

    def offer(self, queries: np.ndarray, begin: int, end: int) -> None:
        """Compare ``queries`` with rows begin..end, and keep the best."""
        self.visited += len(queries) * (end - begin)
        near = self.q[queries] @ self.x[begin:end].T
        a, b = np.nonzero(near >= self.best[queries, -1][:, None] - 1e-9)
        a, b = queries[a], b + begin
        other = self.ids[b] != self.query_ids[a]
        a, b = a[other], b[other]
        if not len(a):
            return
        scores, ids = cosine(self.query_raw[a], self.raw[b]), self.ids[b]
        mine = np.unique(a)
        a = np.concatenate([a, np.repeat(mine, self.k)])
        scores = np.concatenate([scores, self.best[mine].ravel()])
        ids = np.concatenate([ids, self.best_ids[mine].ravel()])
        ranked = np.lexsort((ids, -scores, a))
        a, scores, ids = a[ranked], scores[ranked], ids[ranked]
        again = np.zeros(len(a), bool)
        again[1:] = (a[1:] == a[:-1]) & (ids[1:] == ids[:-1]) & (scores[1:] == scores[:-1]) & np.isfinite(scores[1:])
        a, scores, ids = a[~again], scores[~again], ids[~again]
        place = np.arange(len(a)) - np.searchsorted(a, a)
        top = place < self.k
        self.best[a[top], place[top]] = scores[top]
        self.best_ids[a[top], place[top]] = ids[top]

    def from_vantage(self, at: int, queries: np.ndarray) -> np.ndarray:
        begin = self.nodes[at, 0]
        return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (self.q[queries] @ self.x[begin])))

    def run(self) -> None:
        done: list[tuple[int, np.ndarray]] = []
        self.descend(0, np.arange(len(self.q)), done)
        first = dict(done)
        self.visit(0, np.arange(len(self.q)), first)

    def descend(self, at: int, queries: np.ndarray, done: list) -> None:
        """Each query's own leaf comes first, for a bound to prune with."""
        if not len(queries):
            return
        begin, end, left, right = self.nodes[at]
        if left < 0:
            self.offer(queries, begin, end)
            done.append((at, queries))
            return
        near = self.from_vantage(at, queries) <= self.radii[at, 1]
        self.descend(left, queries[near], done)
        self.descend(right, queries[~near], done)

    def visit(self, at: int, queries: np.ndarray, first: dict) -> None:
        if not len(queries):
            return
        begin, end, left, right = self.nodes[at]
        if left < 0:
            seen = first.get(at)
            self.offer(queries if seen is None else np.setdiff1d(queries, seen), begin, end)
            return
        self.offer(queries, begin, begin + 1)
        far = self.from_vantage(at, queries)
        for child, low, high in ((left, *self.radii[at, :2]), (right, *self.radii[at, 2:])):
            bound = np.maximum(far - high, low - far) - SLACK
            worst = self.best[queries, -1]
            reach = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * np.where(np.isfinite(worst), worst, -1.0))) / self.factor
            self.visit(child, queries[~((bound > reach + SLACK) & np.isfinite(worst))], first)


def lean(x: np.ndarray) -> bytes:
    """The components as floats where these hold them exactly, else as doubles."""
    with np.errstate(over="ignore"):
        short = x.astype(np.float32)
    return (short if np.array_equal(short, x) else x).tobytes()


def full(held: pa.Buffer, rows: int, width: int) -> np.ndarray:
    """What :func:`lean` packed, as doubles."""
    return np.frombuffer(held, np.float32 if held.size == 4 * rows * width else np.float64).reshape(rows, width).astype(np.float64)


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, factor: float = FACTOR, shard_rows: int = SHARD_ROWS,
            query_rows: int = QUERY_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest rows of ``vec_id, embedding`` to those where ``is_query``."""
    if factor < 1:
        raise ValueError("factor is at least 1, which is exact search")
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), packed(F.col("embedding")).alias("v"), is_query.alias("asks")).where(
        F.col("id").isNotNull() & usable(F.col("v")))
    total, asking = rows.agg(F.count(F.lit(1)), F.count(F.when(F.col("asks"), 1))).first()
    shards, blocks = max(1, -(-total // shard_rows)), max(1, -(-asking // query_rows))

    def planted(table: pa.Table) -> pa.Table:
        raw, _ = matrix(table.column("v"))
        order, nodes, radii = build(unit(raw))
        ids = table.column("id").to_numpy()[order]
        return pa.table({"shard": table.column("shard")[:1], "width": table.column("width")[:1],
                         "ids": pa.array([ids.tobytes()], pa.binary()), "raw": pa.array([lean(raw[order])], pa.binary()),
                         "nodes": pa.array([nodes.tobytes()], pa.binary()), "radii": pa.array([radii.tobytes()], pa.binary())})

    def blocked(table: pa.Table) -> pa.Table:
        raw, _ = matrix(table.column("v"))
        return pa.table({"block": table.column("block")[:1], "query_width": table.column("width")[:1],
                         "query_ids": pa.array([table.column("id").to_numpy().tobytes()], pa.binary()),
                         "queries": pa.array([lean(raw)], pa.binary())})

    trees = written(rows.select("id", "v", F.size("v").alias("width"), F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard")).groupBy(
        "shard", "width").applyInArrow(planted, "shard int, width int, ids binary, raw binary, nodes binary, radii binary"), "trees")
    asked = rows.where("asks").select("id", "v", F.size("v").alias("width"), F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block")).groupBy(
        "block", "width").applyInArrow(blocked, "block int, query_width int, query_ids binary, queries binary")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, tree, best = None, None, {}
        for batch in batches:
            for row in range(batch.num_rows):
                shard, width, block = (batch.column(name)[row].as_py() for name in ("shard", "width", "block"))
                held = {name: batch.column(name)[row].as_buffer() for name in ("ids", "raw", "nodes", "radii", "query_ids", "queries")}
                if at != (shard, width):
                    ids = np.frombuffer(held["ids"], np.int64).copy()
                    raw = full(held["raw"], len(ids), width)
                    at, tree = (shard, width), (ids, raw, np.frombuffer(held["nodes"], np.int64).reshape(-1, 4).copy(),
                                                np.frombuffer(held["radii"]).reshape(-1, 4).copy(), unit(raw))
                *parts, x = tree
                query_ids = np.frombuffer(held["query_ids"], np.int64)
                found = Search(*parts, query_ids, full(held["queries"], len(query_ids), width), k, factor, x, best.get((block, width), [None])[1:])
                found.run()
                best[block, width] = query_ids.copy(), found.best, found.best_ids
        for query_ids, scores, ids in best.values():
            q, j = np.nonzero(np.isfinite(scores))
            yield pa.RecordBatch.from_arrays([pa.array(query_ids[q]), pa.array(ids[q, j]), pa.array(scores[q, j])], names=["query_id", "vec_id", "score"])

    pairs = trees.join(asked.repartition(-(-blocks // QUERY_BLOCKS)).hint("shuffle_replicate_nl"), F.col("width") == F.col("query_width"))
    found = pairs.mapInArrow(tidy(search), "query_id long, vec_id long, score double").dropDuplicates(["query_id", "vec_id", "score"])
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
