"""Boosted trees grown on histograms of slopes and curvatures.

A table is binned once: each column has at most ``max_bin`` bins, cut at weighted quantiles (at every value, where a column
has no more than that), and a bin of its own for NaN, which is a missing value. The binned rows are written with their margins. A
level of a tree, for all classes at once, is one pass: tasks add up slope and curvature per (tree, node, column, bin),
Spark sums the cells, and windows over (tree, node, column) give each cut's gain; only the best cut of every node comes to
the driver. After a round the rows are written again with their new margins, so no pass scores former trees.

With G and H the sums of slope and curvature of a node, its step is ``w = -shrunk(G) / (H + lambda)``, where
``shrunk`` takes ``alpha`` off the size of G, and ``max_delta_step`` (unless 0) bounds w. Its score is
``-(2 G w + (H + lambda) w^2 + 2 alpha |w|)``. A cut's gain is the scores of both sides less the node's. A side
needs a curvature of ``min_child_weight``, a cut a gain of ``gamma``; of cuts with equal gains, as 32-bit floats, the lower column
wins, then the lower bin. Missing values go to the side that gains more, left if both do.

Random choices can be repeated anywhere: each compares the first 8 hexadecimal digits of an md5 digest. A row is in
round r if that of ``<seed>:<r>:<key>`` is below the share; a tree has the columns with the least digests of
``<seed>:<r>:<class>:<column>``, and a level those of them with the least ``<seed>:<r>:<class>:<level>:<column>``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from featherline.functions import vectors
from featherline.workspace import discard, new_path

#: Numbers of a task's histograms that are held in memory; beyond, every batch sends its cells.
DENSE_CELLS = 4_000_000
#: Values per bin that a task keeps of a column with more values than bins.
SUMMARY = 8
#: A gain of no more than this share of the scores it comes from is rounding.
ROUNDING = 1e-12
CELLS = "tree int, node int, feature int, bin int, g double, h double"


def chance(*parts) -> float:
    """A number in [0, 1) that depends on ``parts`` alone."""
    return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:8], 16) / 2.0 ** 32


def row_chance(prefix: str, key: Column) -> Column:
    """:func:`chance` of a prefix and a row's key, as an expression."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{prefix}:"), key.cast("string"))), 1, 8), 16, 10).cast("long") / F.lit(2.0 ** 32)


def some_columns(columns: list[int], share: float, *parts) -> list[int]:
    """The share of ``columns`` with the least digests, one at least."""
    if share >= 1:
        return columns
    ranked = sorted(columns, key=lambda c: (chance(*parts, c), c))
    return sorted(ranked[:max(1, int(share * len(columns)))])


@dataclass
class Settings:
    """What the grower needs of the hyperparameters."""

    rounds: int
    classes: int
    eta: float
    gamma: float
    depth: int
    least_weight: float
    ridge: float
    lasso: float
    largest_step: float
    subsample: float
    by_tree: float
    by_level: float
    bins: int
    seed: int
    start: float
    dart: dict = field(default_factory=dict)


@dataclass
class Tree:
    """Nodes of a tree; node 0 is the root, a leaf has left = -1."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [-1])
    missing_left: list[int] = field(default_factory=lambda: [1])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])
    cover: list[float] = field(default_factory=lambda: [0.0])

    def add(self) -> int:
        for held, empty in ((self.feature, -1), (self.bin, -1), (self.missing_left, 1), (self.left, -1), (self.right, -1),
                            (self.value, 0.0), (self.gain, 0.0), (self.cover, 0.0)):
            held.append(empty)
        return len(self.left) - 1

    def leaf_of(self, bins: np.ndarray, missing: int) -> np.ndarray:
        """The node each row of binned columns ends in."""
        feature, at, left, right = (np.array(x) for x in (self.feature, self.bin, self.left, self.right))
        missing_left = np.array(self.missing_left, bool)
        node = np.zeros(len(bins), np.int64)
        rows = np.flatnonzero(left[node] >= 0)
        while len(rows):
            here = node[rows]
            held = bins[rows, feature[here]].astype(np.int64)
            goes_left = np.where(held == missing, missing_left[here], held <= at[here])
            node[rows] = np.where(goes_left, left[here], right[here])
            rows = rows[left[node[rows]] >= 0]
        return node


def table_of(trees: list[list[Tree]], cuts: list[np.ndarray]) -> np.ndarray:
    """All nodes as numbers: round, class, node, column, threshold, missing left, left, right, value, gain, cover."""
    rows = []
    for step, of_round in enumerate(trees):
        for number, tree in enumerate(of_round):
            for node in range(len(tree.left)):
                inner = tree.left[node] >= 0
                rows.append([step, number, node, tree.feature[node], cuts[tree.feature[node]][tree.bin[node]] if inner else 0.0, tree.missing_left[node],
                             tree.left[node], tree.right[node], tree.value[node], tree.gain[node], tree.cover[node]])
    return np.array(rows, float).reshape(-1, 11)


def margins(x: np.ndarray, nodes: np.ndarray, weights: np.ndarray, classes: int, start: float) -> np.ndarray:
    """Margins of rows of columns by the nodes of :func:`table_of` and a weight for every round."""
    found = np.full((len(x), classes), start)
    firsts = np.flatnonzero(nodes[:, 2] == 0)
    for begin, end in zip(firsts, [*firsts[1:], len(nodes)]):
        tree = nodes[begin:end]
        feature, left, right = (tree[:, k].astype(np.int64) for k in (3, 6, 7))
        at = np.zeros(len(x), np.int64)
        rows = np.flatnonzero(left[at] >= 0)
        while len(rows):
            here = at[rows]
            held = x[rows, feature[here]]
            goes_left = np.where(np.isnan(held), tree[here, 5] > 0, held <= tree[here, 4])
            at[rows] = np.where(goes_left, left[here], right[here])
            rows = rows[left[at[rows]] >= 0]
        found[:, int(tree[0, 1])] += weights[int(tree[0, 0])] * tree[at, 8]
    return found


def summary(values: np.ndarray, weights: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values with their weights; if there are over ``most``, as many at even steps of weight, with least and largest."""
    order = np.argsort(values, kind="stable")
    values, weights = values[order], weights[order]
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)
    values, weights = values[first], np.add.reduceat(weights, first) if len(first) else weights[:0]
    if len(values) <= most:
        return values, weights
    upto = np.cumsum(weights)
    chosen = np.unique(np.append(np.searchsorted(upto, upto[-1] * np.arange(1, most) / most), [0, len(values) - 1]))
    return values[chosen], np.diff(np.append(0.0, upto[chosen]))


def cut_points(table: DataFrame, features: str, weight: str, width: int, most: int) -> list[np.ndarray]:
    """The upper bounds of every column's bins, at most ``most``, the last being the largest value."""
    keep = SUMMARY * most

    def summarize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(np.zeros(0), np.zeros(0))] * width
        for batch in batches:
            x = vectors.to_matrix(batch.column(0), width)
            w = batch.column(1).to_numpy(zero_copy_only=False)
            for c in range(width):
                known = ~np.isnan(x[:, c]) & (w > 0)
                held[c] = summary(np.append(held[c][0], x[known, c]), np.append(held[c][1], w[known]), keep)
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), *[pa.array([h[k].tobytes() for h in held], pa.binary()) for k in (0, 1)]],
                                         names=["feature", "points", "weights"])

    def cut(told: pa.Table) -> pa.Table:
        points, weights = (np.concatenate([np.frombuffer(v.as_py()) for v in told.column(name)]) for name in ("points", "weights"))
        points, weights = summary(points, weights, keep * told.num_rows)
        if len(points) > most:
            upto = np.cumsum(weights)
            points = points[np.unique(np.append(np.searchsorted(upto, upto[-1] * np.arange(1, most) / most), len(points) - 1))]
        return pa.table({"feature": told.column("feature")[:1], "cuts": pa.array([points.tobytes()], pa.binary())})

    rows = table.select(vectors.lean(F.col(features)).alias("x"), F.col(weight)).mapInArrow(summarize, "feature int, points binary, weights binary").groupBy(
        "feature").applyInArrow(cut, "feature int, cuts binary").collect()
    found = {row.feature: np.frombuffer(bytes(row.cuts)) for row in rows}
    return [found.get(c, np.zeros(0)) for c in range(width)]


def _score(g: Column, h: Column, s: Settings) -> Column:
    """Score of a node by its sums."""
    w = _step(g, h, s)
    return -(2 * g * w + (h + s.ridge) * w * w + 2 * s.lasso * F.abs(w))


def _step(g: Column, h: Column, s: Settings) -> Column:
    shrunk = F.signum(g) * F.greatest(F.abs(g) - s.lasso, F.lit(0.0))
    w = F.when(h + s.ridge > 0, -shrunk / (h + s.ridge)).otherwise(0.0)
    return F.least(F.greatest(w, F.lit(-s.largest_step)), F.lit(s.largest_step)) if s.largest_step else w


def step(g: float, h: float, s: Settings) -> float:
    """A leaf's step by its sums, before eta; none below the least weight."""
    if h < s.least_weight or h + s.ridge <= 0:
        return 0.0
    w = -np.sign(g) * max(abs(g) - s.lasso, 0.0) / (h + s.ridge)
    return float(np.clip(w, -s.largest_step, s.largest_step)) if s.largest_step else float(w)


def best_cuts(cells: DataFrame, s: Settings) -> DataFrame:
    """For each (tree, node) its sums ``g, h``, and of its best cut ``gain, feature, bin, missing_left`` and the left side's ``left_g, left_h``, null without one.

    Bin -1 holds the missing values.
    """
    summed = cells.repartition("tree", "node", "feature").groupBy("tree", "node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
    whole = Window.partitionBy("tree", "node", "feature")
    upto = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    told = summed.select("tree", "node", "feature", "bin", *[F.sum(x).over(whole).alias(f"all_{x}") for x in "gh"],
                         *[F.sum(x).over(upto).alias(f"left_{x}") for x in "gh"],
                         *[F.coalesce(F.sum(F.when(F.col("bin") < 0, F.col(x))).over(whole), F.lit(0.0)).alias(f"none_{x}") for x in "gh"])

    def gain(without: bool) -> Column:
        g, h = (F.col(f"left_{x}") - F.col(f"none_{x}") if without else F.col(f"left_{x}") for x in "gh")
        rest_g, rest_h = F.col("all_g") - g, F.col("all_h") - h
        least = F.lit(max(s.least_weight, 1e-12))
        both = _score(g, h, s) + _score(rest_g, rest_h, s)
        more = both - _score(F.col("all_g"), F.col("all_h"), s)
        return F.when((F.col("bin") >= 0) & (h >= least) & (rest_h >= least) & (more > ROUNDING * both), more)

    sides = told.withColumns({"with": gain(False), "without": gain(True)}).withColumn("missing_left", F.coalesce(F.col("with") >= F.col("without"), F.col("with").isNotNull()))
    cut = F.struct(F.greatest("with", "without").cast("float").alias("gain"), (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"), "missing_left",
                   *[(F.col(f"left_{x}") - F.when(F.col("missing_left"), 0.0).otherwise(F.col(f"none_{x}"))).alias(f"left_{x}") for x in "gh"])
    best = sides.groupBy("tree", "node").agg(F.max(F.when(F.greatest("with", "without").isNotNull(), cut)).alias("cut"),
                                             F.max_by("all_g", -F.col("feature")).alias("g"), F.max_by("all_h", -F.col("feature")).alias("h"))
    return best.select("tree", "node", "g", "h", F.col("cut.gain").alias("gain"), (-F.col("cut.f")).alias("feature"), (-F.col("cut.b")).alias("bin"), "cut.missing_left",
                       "cut.left_g", "cut.left_h")


#: Slope and curvature per class of rows with these margins, labels and weights.
Slopes = Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


class Forest:
    """Grows trees round by round over a written table of binned rows."""

    def __init__(self, table: DataFrame, features: str, columns: dict[str, Column], width: int, settings: Settings):
        """``columns`` name ``label``, ``weight``, ``key`` and ``held_out`` of a row, and others that slopes need."""
        self.settings, self.width, self.spark = settings, width, table.sparkSession
        named = table.select(F.col(features).alias("x"), *[c.alias(name) for name, c in columns.items()])
        self.cuts = cut_points(named.where("NOT held_out"), "x", "weight", width, settings.bins)
        self.kind = np.uint8 if max(map(len, self.cuts), default=0) < 255 else np.uint16 if max(map(len, self.cuts), default=0) < 65535 else np.uint32
        self.missing = int(np.iinfo(self.kind).max)
        self.trees: list[list[Tree]] = []
        self.weights: list[float] = []
        self.path = None
        self.others = [name for name in named.columns if name != "x"]
        cuts, kind, missing, start, classes, others = self.cuts, self.kind, self.missing, settings.start, settings.classes, self.others
        packed, listed = self.packed, self.listed

        def bin_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = vectors.to_matrix(batch.column("x"), width)
                binned = np.full(x.shape, missing, kind)
                for c in range(width):
                    known = ~np.isnan(x[:, c])
                    if len(cuts[c]):
                        binned[known, c] = np.minimum(np.searchsorted(cuts[c], x[known, c], "left"), len(cuts[c]) - 1)
                yield pa.RecordBatch.from_arrays([*[batch.column(name) for name in others], packed(binned), listed(np.full((len(x), classes), start))],
                                                 names=[*others, "bins", "margin"])

        lean = named.withColumn("x", vectors.lean(F.col("x")))
        schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in named.schema if f.name != "x"], "bins binary, margin array<double>"])
        self.schema = schema
        self._write(lean.mapInArrow(bin_rows, schema))

    @staticmethod
    def packed(binned: np.ndarray) -> pa.Array:
        n, size = len(binned), binned.shape[1] * binned.itemsize
        return pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer((np.arange(n + 1) * size).astype(np.int32).tobytes()), pa.py_buffer(binned.tobytes())])

    @staticmethod
    def listed(rows: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * rows.shape[1], pa.int32()), pa.array(rows.ravel()))

    def _write(self, rows: DataFrame) -> None:
        """The rows, written; what was written of them before goes."""
        before, self.path = self.path, new_path(self.spark, "binned")
        rows.write.parquet(self.path)
        self.rows = self.spark.read.schema(rows.schema).parquet(self.path)
        if before:
            discard(self.spark, before)

    def close(self) -> None:
        discard(self.spark, self.path)

    def reader(self) -> Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray]]:
        """What gives bins and margins of a batch."""
        width, kind, classes = self.width, self.kind, self.settings.classes

        def read(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
            n = batch.num_rows
            held = batch.column("bins")
            _, places, data = held.buffers()
            begin = int(np.frombuffer(places, np.int32, 1, held.offset * 4)[0]) if n else 0
            return (np.frombuffer(data, kind, n * width, begin).reshape(n, width) if n else np.zeros((0, width), kind),
                    batch.column("margin").flatten().to_numpy(zero_copy_only=False).reshape(n, classes))

        return read

    def _dropped(self, step_number: int) -> list[int]:
        """Rounds left out while this one grows."""
        how, seed = self.settings.dart, self.settings.seed
        rate = how.get("rate_drop", 0.0)
        if not how or not self.trees or chance(seed, step_number, "skip") < how.get("skip_drop", 0.0):
            return []
        even = how.get("sample_type", "uniform") == "uniform"
        total = sum(self.weights)
        share = [rate if even or not total else rate * len(self.weights) * w / total for w in self.weights]
        dropped = [t for t, p in enumerate(share) if chance(seed, step_number, "drop", t) < p]
        if not dropped and how.get("one_drop"):
            dropped = [min(range(len(self.trees)), key=lambda t: chance(seed, step_number, "drop", t) / max(share[t], 1e-300) if rate else chance(seed, step_number, "drop", t))]
        return dropped

    def _sum_of(self, rounds: list[int], weights: list[float]) -> Callable[[np.ndarray], np.ndarray]:
        """What some rounds add to the margins of binned rows."""
        trees, missing, classes = [(self.trees[t], w) for t, w in zip(rounds, weights)], self.missing, self.settings.classes

        def add(bins: np.ndarray) -> np.ndarray:
            total = np.zeros((len(bins), classes))
            for of_round, weight in trees:
                for k, tree in enumerate(of_round):
                    total[:, k] += weight * np.array(tree.value)[tree.leaf_of(bins, missing)]
            return total

        return add

    def round(self, slopes: Slopes | None, sloped: DataFrame | None = None) -> None:
        """Grow a tree per class. ``sloped`` has the rows with columns ``g`` and ``h``, where a function of the row alone does not give them."""
        s, number = self.settings, len(self.trees)
        dropped = self._dropped(number)
        without = self._sum_of(dropped, [self.weights[t] for t in dropped])
        rows = (self.rows if sloped is None else sloped).where("NOT held_out")
        if s.subsample < 1:
            rows = rows.where(row_chance(f"{s.seed}:{number}", F.col("key")) < s.subsample)
        rows = rows.select("bins", "margin", *(["label", "weight"] if sloped is None else ["g", "h"]))
        trees = [Tree() for _ in range(s.classes)]
        allowed = [some_columns(list(range(self.width)), s.by_tree, s.seed, number, k) for k in range(s.classes)]
        growing = [(k, 0) for k in range(s.classes)]  # (class, node)
        level = 0
        while growing:
            columns = [some_columns(allowed[k], s.by_level, s.seed, number, k, level) for k in range(s.classes)]
            found = best_cuts(rows.mapInArrow(self._cells(trees, growing, columns, slopes, without if dropped else None), CELLS), s).collect()
            following = []
            for row in sorted(found, key=lambda r: (r.tree, r.node)):
                tree, node = trees[row.tree], row.node
                tree.value[node], tree.cover[node] = s.eta * step(row.g, row.h, s), row.h
                if row.gain is None or row.gain < s.gamma:
                    continue
                tree.feature[node], tree.bin[node], tree.missing_left[node], tree.gain[node] = row.feature, row.bin, int(row.missing_left), row.gain
                tree.left[node], tree.right[node] = tree.add(), tree.add()
                for child, g, h in ((tree.left[node], row.left_g, row.left_h), (tree.right[node], row.g - row.left_g, row.h - row.left_h)):
                    tree.value[child], tree.cover[child] = s.eta * step(g, h, s), h
                    following.append((row.tree, child))
            level += 1
            growing = following if not s.depth or level < s.depth else []
        self._commit(trees, dropped)

    def _commit(self, trees: list[Tree], dropped: list[int]) -> None:
        """Keep the round's trees, weigh the dropped ones anew and write the rows with their margins."""
        s = self.settings
        k, new, factor = len(dropped), 1.0, 1.0
        if k:
            forest = s.dart.get("normalize_type", "tree") == "forest"
            factor, new = (1 / (1 + s.eta), 1 / (1 + s.eta)) if forest else (k / (k + s.eta), 1 / (k + s.eta))
        less = [self.weights[t] * (factor - 1) for t in dropped]
        for t in dropped:
            self.weights[t] *= factor
        self.trees.append(trees)
        self.weights.append(new)
        add, read, listed, others = self._sum_of([*dropped, len(self.trees) - 1], [*less, new]), self.reader(), self.listed, self.others

        def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bins, margin = read(batch)
                yield pa.RecordBatch.from_arrays([*[batch.column(name) for name in others], batch.column("bins"), listed(margin + add(bins))],
                                                 names=[*others, "bins", "margin"])

        self._write(self.rows.mapInArrow(update, self.schema))

    def _cells(self, trees: list[Tree], growing: list[tuple[int, int]], columns: list[list[int]], slopes: Slopes | None, without):
        """A task's sums of slope and curvature in the nodes that grow."""
        missing, read, classes = self.missing, self.reader(), self.settings.classes
        n_bins = max(map(len, self.cuts), default=0) + 1  # the first one for missing values
        nodes = [[node for k, node in growing if k == c] for c in range(classes)]
        sizes = [len(nodes[k]) * len(columns[k]) * n_bins for k in range(classes)]
        dense = 2 * sum(sizes) <= DENSE_CELLS

        def told(k: int, f: int, at: np.ndarray, g: np.ndarray, h: np.ndarray) -> list[np.ndarray]:
            """Columns of the cells at these places, (node, bin) counted through."""
            node = np.array(nodes[k], np.int32)[at // n_bins]
            return [np.full(len(at), k, np.int32), node, np.full(len(at), f, np.int32), (at % n_bins - 1).astype(np.int32), g, h]

        def batch_of(parts: list[list[np.ndarray]]) -> pa.RecordBatch:
            kinds = (np.int32,) * 4 + (np.float64,) * 2
            joined = [np.concatenate([p[c] for p in parts]) if parts else np.zeros(0, kinds[c]) for c in range(6)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in joined], names=["tree", "node", "feature", "bin", "g", "h"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = [np.zeros((2, len(columns[k]), len(nodes[k]) * n_bins)) for k in range(classes)] if dense else None
            for batch in batches:
                bins, margin = read(batch)
                if without is not None:
                    margin = margin - without(bins)
                if slopes is None:
                    g, h = (batch.column(name).to_numpy(zero_copy_only=False)[:, None] for name in ("g", "h"))
                else:
                    g, h = slopes(margin, *(batch.column(name).to_numpy(zero_copy_only=False) for name in ("label", "weight")))
                parts = []
                for k in range(classes):
                    if not nodes[k]:
                        continue
                    place = np.full(len(trees[k].left), -1, np.int64)
                    place[nodes[k]] = np.arange(len(nodes[k]))
                    at = place[trees[k].leaf_of(bins, missing)]
                    inside = np.flatnonzero(at >= 0)
                    base, gk, hk = at[inside] * n_bins, g[inside, k], h[inside, k]
                    for c, f in enumerate(columns[k]):
                        held = bins[inside, f].astype(np.int64)
                        cell = base + np.where(held == missing, 0, held + 1)
                        if dense:
                            size = sums[k].shape[2]
                            sums[k][0, c] += np.bincount(cell, gk, size)
                            sums[k][1, c] += np.bincount(cell, hk, size)
                        else:
                            some, inverse = np.unique(cell, return_inverse=True)
                            parts.append(told(k, f, some, np.bincount(inverse, gk), np.bincount(inverse, hk)))
                if not dense:
                    yield batch_of(parts)
            if dense:
                parts = []
                for k in range(classes):
                    for c, f in enumerate(columns[k]):
                        some = np.flatnonzero(sums[k][:, c].any(axis=0))
                        parts.append(told(k, f, some, sums[k][0, c, some], sums[k][1, c, some]))
                yield batch_of(parts)

        return run
