"""Embedding near-duplicates: iterative quantisation, multi-index Hamming tables, and exact reranking.

1. Equal vectors become one class, so that groups of copies cost nothing further on.
2. Rotations are learned on a bounded sample (``SAMPLE`` classes of the smallest hash): principal axes, then
   the rotation whose signs lose least, which makes every bit split the data about evenly. Several
   rotations give as many bits as the tables need.
3. A code is cut into substrings, one per table. Their width follows the logarithm of the number of
   classes, as is usual for multi-index hashing. Rotations are of centered vectors, where a pair at the threshold
   lies further apart the longer the mean is, so the number of tables is counted: sample vectors are paired with vectors
   at the threshold from them (in any direction, and towards other sample vectors), and of both kinds ``RECALL``
   has to meet in some table, and never fewer tables than angle / pi as the chance of a differing bit asks for. Where ``TABLES`` are too few for that, substrings get shorter.
4. Classes that share a substring are compared with their original vectors in double precision, in blocks: a
   bucket of more than ``BLOCK`` classes is cut into parts, and every two parts are a block of their own. A
   pair counts in the first table in which it meets. A block gives one count per class and the links that
   span it, never all its pairs.
5. Components of the spanning links.

Vectors that are null, zero, or hold null or non-finite components link with nothing; vectors of different
lengths are not linked. Rows that repeat a vec_id count as further vectors. A row without an id has no links and no
component, and is kept. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import acos, ceil, log, log2, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from featherline.llm.connected import components
from featherline.llm.groups import first_reached, fixed, pairs, starts, whole_groups
from featherline.llm.tasks import tidy
from featherline.llm.vectors import cosine, matrix, packed, unit, usable
from featherline.workspace import written

SAMPLE, ROUNDS, BLOCK, RECALL, SEED = 12288, 30, 2048, 0.97, 5
#: Most tables; where more would be needed, substrings get shorter. Pairs at the threshold that the plan is tried on.
TABLES, PROBES = 64, 4000
#: Rows of a block whose pairs are listed with those of others; larger blocks are multiplied out.
FEW = 48


def rotations(x: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean, and a matrix that maps centered rows to ``bits`` numbers whose signs are the code."""
    mean = x.mean(axis=0)
    centered = x - mean
    _, _, axes = np.linalg.svd(centered.T @ centered)
    random = np.random.default_rng(SEED)
    found, held = [], 0
    while held < bits:
        turn = np.linalg.qr(random.normal(size=(len(axes), len(axes))))[0]
        projected = centered @ axes.T
        for _ in range(ROUNDS):
            signs = np.where(projected @ turn >= 0, 1.0, -1.0)
            u, _, v = np.linalg.svd(signs.T @ projected)
            turn = (u @ v).T
        found.append(axes.T @ turn)
        held += len(axes)
    return mean, np.concatenate(found, axis=1)[:, :bits]


def at_threshold(x: np.ndarray, threshold: float, other: np.ndarray | None = None) -> np.ndarray:
    """For every unit vector one of that cosine with it, turned towards ``other`` or, by default, in any direction."""
    off = np.random.default_rng(SEED).normal(size=x.shape) if other is None else other
    off = off - (off * x).sum(axis=1, keepdims=True) * x
    length = np.sqrt((off * off).sum(axis=1, keepdims=True))
    flat = length < 1e-9  # nothing else to turn to
    return np.where(flat, x, threshold * x + np.sqrt(1 - threshold * threshold) * off / np.where(flat, 1.0, length))


def plan(x: np.ndarray, classes: int, threshold: float, recall: float = RECALL) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Mean and rotation of :func:`rotations`, bits of a substring and number of tables for ``classes``, seen on the unit vectors ``x``."""
    width = min(24, max(8, ceil(log2(max(classes, 2)))))
    # Signs fit the vectors that they were learned on better than others, so it is tried on a third kept apart.
    learned, apart = x[:max(1, len(x) * 2 // 3)], x[len(x) * 2 // 3:]
    mean, turn = rotations(learned, width * TABLES)
    a, b = np.random.default_rng(SEED).integers(0, len(apart), (2, PROBES))
    probes, x = apart[a], apart
    near = [(at_threshold(probes, threshold, other) - mean) @ turn >= 0 for other in (None, x[b])]
    same = [n == ((probes - mean) @ turn >= 0) for n in near]
    while width:
        held = width * TABLES
        met = [np.logical_or.accumulate(s[:, :held].reshape(PROBES, TABLES, width).all(axis=2), axis=1).mean(axis=0) for s in same]
        enough = np.flatnonzero(np.minimum(*met) >= recall)
        if len(enough):
            meets = (1 - acos(threshold) / pi) ** width
            tables = max(int(enough[0]) + 1, min(TABLES, ceil(log(1 - recall) / log(1 - meets))))
            return mean, turn[:, :width * tables], width, tables
        width -= 1
    return mean, np.zeros((x.shape[1], 1)), 1, 1  # one bucket


def substrings(x: np.ndarray, mean: np.ndarray, turn: np.ndarray, width: int) -> np.ndarray:
    """One integer per table for every row."""
    bits = ((x - mean) @ turn >= 0).reshape(len(x), -1, width)
    return bits @ (1 << np.arange(width, dtype=np.int64))


def linked(x: np.ndarray, y: np.ndarray, ux: np.ndarray, uy: np.ndarray, threshold: float) -> np.ndarray:
    """Matrix of whether the cosine reaches the threshold; what rounding could decide is computed per pair."""
    near = ux @ uy.T
    found = near >= threshold
    a, b = np.nonzero(np.abs(near - threshold) < 1e-9)
    if len(a):
        found[a, b] = cosine(x[a], y[b]) >= threshold
    return found


def _few(size: np.ndarray, small: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every pair of rows within those groups that are ``small``."""
    rows = np.flatnonzero(np.repeat(small, size))
    few = size[small]
    first, second = pairs(np.cumsum(few) - few, len(rows))
    return rows[first], rows[second]


def near_duplicates(vectors: DataFrame, threshold: float = 0.95) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vec_id, embedding``."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), packed(F.col("embedding")).alias("v"))
    rows = rows.select("vec_id", F.when(usable(F.col("v")) & F.col("vec_id").isNotNull(), F.col("v")).alias("v"))
    classes = written(rows.where("v IS NOT NULL").groupBy("v").agg(
        F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies")), "vector-classes")
    longest, total = classes.agg(F.max(F.size("v")), F.count(F.lit(1))).first()
    if not total:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))

    def filled(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        x, lengths = matrix(column)
        return np.pad(x, ((0, 0), (0, longest - x.shape[1]))), lengths

    held = classes.select("v").orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toArrow()
    mean, turn, width, tables = plan(unit(filled(held.column("v"))[0]), total, threshold)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, lengths = filled(batch.column("v"))
            codes = substrings(unit(x), mean, turn, width).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), batch.column("copies"), pa.array([r.tobytes() for r in x], pa.binary()), pa.array(lengths, pa.int32()),
                pa.array([r.tobytes() for r in codes], pa.binary()), pa.array(list(codes), pa.list_(pa.int32()))],
                names=["id", "copies", "x", "length", "code", "parts"])

    coded = written(classes.select("id", "copies", "v").mapInArrow(tidy(encode), "id long, copies long, x binary, length int, code binary, parts array<int>"), "vector-codes")
    slots = coded.select("id", F.posexplode("parts").alias("t", "part"))
    shared = slots.groupBy("t", "part").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    shared = written(shared.select(
        F.col("t").alias("_t"), F.col("part").alias("_part"), F.ceil(F.col("_n") / F.lit(BLOCK)).cast("int").alias("cuts")), "buckets")
    cut = slots.join(shared, (F.col("t") == F.col("_t")) & (F.col("part") == F.col("_part"))).select(
        "id", "t", "part", "cuts", F.pmod(F.xxhash64("id", F.lit(3)), F.col("cuts")).cast("int").alias("mine"))
    other = F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))
    placed = cut.withColumn("other", other).select(
        "id", "t", "part", "mine", F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b"))
    keys = ["t", "part", "a", "b"]
    blocks = placed.join(coded.drop("parts"), "id").repartition(*keys).sortWithinPartitions(*keys, "id")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, keys):
            ids, copies, t, length, mine, a, b = (table.column(c).to_numpy() for c in ("id", "copies", "t", "length", "mine", "a", "b"))
            x, code = fixed(table.column("x"), np.float64, longest), fixed(table.column("code"), np.int32, tables)
            u = unit(x)
            begin = starts(table, keys)
            size = np.diff(np.append(begin, len(ids)))
            first, second = _few(size, size <= FEW)
            near = np.einsum("ij,ij->i", u[first], u[second])
            good = near >= threshold
            unsure = np.abs(near - threshold) < 1e-9
            good[unsure] = cosine(x[first[unsure]], x[second[unsure]]) >= threshold
            left, right = [first[good]], [second[good]]
            for at in np.flatnonzero(size > FEW):
                rows = slice(begin[at], begin[at] + size[at])
                i, j = np.nonzero(np.triu(linked(x[rows], x[rows], u[rows], u[rows], threshold), 1))
                left.append(i + begin[at])
                right.append(j + begin[at])
            i, j = np.concatenate(left), np.concatenate(right)
            keep = (length[i] == length[j]) & ((a[i] == b[i]) | (mine[i] != mine[j]))
            i, j = i[keep], j[keep]
            # The first table in which two codes agree is where the pair counts.
            new = (code[i] == code[j]).argmax(axis=1) == t[i]
            i, j = i[new], j[new]
            counts = np.bincount(i, weights=copies[j], minlength=len(ids)) + np.bincount(j, weights=copies[i], minlength=len(ids))
            to = ids[first_reached(i, j, len(ids))]
            some = counts > 0
            yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(counts[some].astype(np.int64)), pa.array(to[some])], names=["id", "n", "to"])

    found = written(blocks.mapInArrow(tidy(compare), "id long, n long, to long"), "vector-links")
    links = found.groupBy("id").agg(F.sum("n").alias("n"))
    whole = components(found.select(F.col("id").alias("a"), F.col("to").alias("b")))
    facts = written(
        classes.join(links, "id", "left").join(whole, "id", "left").select(
            F.col("v").alias("_v"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "id").alias("component_id")), "vector-facts")
    return rows.join(facts, F.col("v") == F.col("_v"), "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(True)).alias("kept"))
