"""Centroid clustering of integer vectors, with centroids filtered by n-simplex projection.

Some pivots are chosen once, and the distances of every vector to them are cached as the apex of a simplex over the
pivots: its coordinates inside their span, and last its height above it. For two apexes p and q, the Euclidean distance
of the coordinates is a lower bound of the distance of the vectors, and the one with the heights added instead of
subtracted an upper bound. In each round a centroid whose lower bound is above the least upper bound is left out;
the others are compared by exact integer distances, so the filter changes no assignment.

Vectors are packed into blocks that are written once: ids, integers in as few bytes as they take, apexes. Each round
reads the blocks, and a task sends one row per centroid and component: sums and counts, which Spark adds up
exactly. The driver has the centroids only. A round that moves no centroid ends the rounds, since all later
ones would do the same.

Vectors with another number of components, null ones, and those with null or non-finite components take no part and are not returned.
Components beyond 2^62 count as 2^62; distances and inertias beyond a long as the last long. Vectors that repeat an id
count each; where they tie for a start, the smaller components go first. Rows without an id take part, but are
starts only if there are too few others. With fewer vectors than centroids each vector is one; an empty table gives no row. Other
columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from featherline.llm.integers import EXACT, LONG, complete, floors, narrow, small, whole, wide
from featherline.llm.tasks import tidy
from featherline.workspace import written

BLOCK_ROWS, PIVOTS = 4096, 16
#: What rounding may add to a bound, relative to the distances it comes from.
SLACK = 1e-6
#: More than any squared distance.
LARGE = 1 << 200
#: A pivot must stand at least this part of its distance from the first above the span of the others.
HEIGHT = 0.1


class Simplex:
    """The simplex over pivots, each with the coordinates that distances to the pivots before it give."""

    def __init__(self, pivots: np.ndarray):
        self.pivots = pivots[:0]
        self.base = np.zeros((0, 0))  # row i: coordinates of pivot i, the last one its height above those before it
        for pivot in pivots:
            if not len(self.pivots):
                self.pivots, self.base = pivot[None], np.zeros((1, 0))
                continue
            apex = self.project(pivot[None])[0]
            if apex[-1] <= HEIGHT * np.sqrt((apex * apex).sum()):
                continue  # within the span of the others, so it would tell nothing
            self.base = np.vstack([np.pad(self.base, ((0, 0), (0, 1))), apex])
            self.pivots = np.vstack([self.pivots, pivot])

    @property
    def least_height(self) -> float:
        return float(np.diag(self.base[1:]).min(initial=np.inf))

    def project(self, x: np.ndarray) -> np.ndarray:
        """Apexes over ``x``: one coordinate less than pivots, then the height."""
        far = np.stack([((x - p) ** 2).sum(axis=1) for p in self.pivots], axis=1)  # squared distances to the pivots
        inner = np.zeros((len(x), len(self.pivots)))
        for i in range(1, len(self.pivots)):
            own = self.base[i]
            inner[:, i - 1] = ((far[:, 0] - far[:, i] + (own * own).sum()) / 2 - inner[:, :i - 1] @ own[:i - 1]) / own[i - 1]
        inner[:, -1] = np.sqrt(np.maximum(0.0, far[:, 0] - (inner[:, :-1] ** 2).sum(axis=1)))
        return inner


def candidates(apexes: np.ndarray, centers: np.ndarray, least_height: float = 1.0) -> np.ndarray:
    """Mask of the centroids (columns) that can be nearest to each row, by the bounds of their apexes."""
    inside = ((apexes[:, None, :-1] - centers[None, :, :-1]) ** 2).sum(axis=2)
    a, b = apexes[:, -1, None], centers[None, :, -1]
    far = np.sqrt((apexes * apexes).sum(axis=1))[:, None] + np.sqrt((centers * centers).sum(axis=1))[None, :]
    slack = SLACK * (1.0 + far + far * far / least_height)
    lower, upper = np.sqrt(inside + (a - b) ** 2) - slack, np.sqrt(inside + (a + b) ** 2) + slack
    return lower <= upper.min(axis=1, keepdims=True)


def assign(x: np.ndarray, apexes: np.ndarray, centers: list[list[int]], simplex: Simplex) -> tuple[np.ndarray, np.ndarray]:
    """(nearest centroid, squared distance as exact integers) of every row; of equal distances the smaller number."""
    y = np.array(centers, np.float64)
    left = candidates(apexes, simplex.project(y), simplex.least_height)
    exact = small(x, y)
    # Doubles where they are exact, else Python's integers; no distance is LARGE.
    nearest, best = np.zeros(len(x), np.int64), np.full(len(x), LARGE, np.float64 if exact else object)
    for c, center in enumerate(centers):
        rows = np.flatnonzero(left[:, c])
        far = ((x[rows] - y[c]) ** 2).sum(axis=1) if exact else ((whole(x[rows]) - np.array(center, dtype=object)) ** 2).sum(axis=1)
        closer = rows[far < best[rows]]
        nearest[closer], best[closer] = c, far[far < best[rows]]
    return nearest, best.astype(np.int64) if exact else best


def _blocks(vectors: DataFrame, width: int, scale: float, simplex: Simplex) -> DataFrame:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, BLOCK_ROWS):
                some = batch.slice(begin, BLOCK_ROWS)
                x = floors(some.column("v"), scale)
                kind, held = narrow(x)
                ids = pa.ListArray.from_arrays(pa.array([0, some.num_rows], pa.int32()), some.column("vec_id"))
                yield pa.RecordBatch.from_arrays([ids, pa.array([kind]), pa.array([held], pa.binary()), pa.array([simplex.project(x).tobytes()], pa.binary())],
                                                 names=["ids", "kind", "v", "apexes"])

    return written(vectors.mapInArrow(tidy(pack), "ids array<long>, kind string, v binary, apexes binary"), "simplex-blocks")


def _read(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(ids, integers, apexes) of each block."""
    for batch in batches:
        for row in range(batch.num_rows):
            ids = batch.column("ids")[row].values
            kind, v, apexes = (batch.column(name)[row].as_py() for name in ("kind", "v", "apexes"))
            yield ids, wide(v, kind, width, len(ids)), np.frombuffer(apexes).reshape(len(ids), -1)


def _decimals(values: list[int]) -> pa.Array:
    return pa.array([Decimal(v) for v in values], pa.decimal128(38, 0))


def _added(x: np.ndarray) -> list[int]:
    """Exact sums of the columns of integers ``x``."""
    if np.abs(x).max(initial=0) * max(len(x), 1) < EXACT:
        return [int(v) for v in x.sum(axis=0)]
    return [int(v) for v in whole(x).sum(axis=0)]


def clusters(vectors: DataFrame, k: int = 8, rounds: int = 10, width: int = 64, scale: float = 1024.0, seed: str = "3", pivots: int = PIVOTS) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of the vectors in ``vec_id, embedding``.

    Components become floor(scale * x). Centroids start as the ``k`` vectors whose sha256 of ``<seed>:<vec_id>`` is smallest.
    """
    wide_v = F.col("embedding").cast("array<double>")
    kept = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), wide_v.alias("v")).where((F.size("v") == width) & complete(F.col("v")))
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = kept.orderBy(order.asc_nulls_last(), "v").limit(k + pivots).select("v").toArrow().column("v").combine_chunks()
    if not len(first):
        return kept.select("vec_id", F.lit(0).alias("cluster"), *[F.lit(0).cast("long").alias(name) for name in ("distance", "cluster_inertia", "inertia")],
                           F.lit("").alias("centroid_sha256"))
    chosen = floors(first, scale)
    centers = [[int(v) for v in row] for row in chosen[:k]]
    simplex = Simplex(chosen[k:] if len(chosen) > k else chosen)
    packed = _blocks(kept, width, scale, simplex)

    for _ in range(rounds):
        def add(batches: Iterator[pa.RecordBatch], centers=centers) -> Iterator[pa.RecordBatch]:
            sums, counts = [[0] * width for _ in centers], [0] * len(centers)
            for _, x, apexes in _read(batches, width):
                nearest, _ = assign(x, apexes, centers, simplex)
                for c in np.unique(nearest).tolist():
                    mine = x[nearest == c]
                    counts[c] += len(mine)
                    sums[c] = [a + b for a, b in zip(sums[c], _added(mine))]
            cells = [(c, d) for c in range(len(centers)) if counts[c] for d in range(width)]
            yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in cells], pa.int32()), pa.array([d for _, d in cells], pa.int32()),
                                              pa.array([counts[c] for c, _ in cells], pa.int64()), _decimals([sums[c][d] for c, d in cells])],
                                             names=["cluster", "component", "n", "total"])

        moved = [list(c) for c in centers]
        for row in packed.mapInArrow(tidy(add), "cluster int, component int, n long, total decimal(38,0)").groupBy("cluster", "component").agg(
                F.sum("n").alias("n"), F.sum("total").alias("total")).collect():  # k * width rows
            moved[row.cluster][row.component] = int(row.total) // row.n
        if moved == centers:
            break
        centers = moved

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        far = [0] * len(centers)
        for _, x, apexes in _read(batches, width):
            nearest, best = assign(x, apexes, centers, simplex)
            for c in np.unique(nearest).tolist():
                far[c] += sum(best[nearest == c].tolist())
        yield pa.RecordBatch.from_arrays([pa.array(range(len(far)), pa.int32()), _decimals([min(d, LONG) for d in far])], names=["cluster", "total"])  # no part need be more than the last long

    totals = {row.cluster: int(row.total) for row in packed.mapInArrow(tidy(measure), "cluster int, total decimal(38,0)").groupBy("cluster").agg(
        F.sum("total").alias("total")).collect()}
    inertia = min(sum(totals.values()), LONG)
    of_cluster = [min(totals.get(c, 0), LONG) for c in range(len(centers))]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x, apexes in _read(batches, width):
            nearest, best = assign(x, apexes, centers, simplex)
            at = pa.array(nearest)
            yield pa.RecordBatch.from_arrays([
                ids, at.cast(pa.int32()), pa.array([min(d, LONG) for d in best], pa.int64()), pa.array(of_cluster, pa.int64()).take(at),
                pa.array(np.full(len(ids), inertia), pa.int64()), pa.array(digests).take(at)],
                names=["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"])

    return packed.mapInArrow(tidy(tell), "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
