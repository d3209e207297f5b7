"""N-gram Jaccard join: points of group counts, an R-tree over them, and exact verification.

A document's set is its distinct shingles (``SIZE`` words, A-Z lower-cased; a text of fewer words is one
shingle). Two sets link when their Jaccard similarity is at least ``PERCENT`` per cent. Shingles are hashed
into ``GROUPS`` groups; how many fall into each is the set's point. Two sets cannot share more than the sum of
the smaller counts of every group, and no point below a node of the tree exceeds the node's largest
counts, so whole subtrees go out by one sum.

Which sets meet in a tree is decided without loss: sets that link differ in at most ``3 * size // 17``
shingles (:func:`allowed`), so when the shingles of one are dealt into more parts than that, some parts are equal in
both. Of the non-empty parts, in an order of their own (fullest first), it is enough to name the first
``allowed + 1``; the rare sets that have too few non-empty parts name them all and share one further name. The
number of parts depends on the power of two that the size lies between, and a set names its parts
for the next one too if a partner can be that large.

Equal sets are one class throughout. Classes with a name in common form candidate groups; in every
group the R-tree leaves the pairs whose bound permits a link, and within what these connect the
shingles themselves are compared, again in the order of the tree. Groups that one task cannot hold are cut into parts, and every two
parts are a block. A block gives links that span it, never all pairs.

A null or empty text, or one of separators only, has the empty set, which links with nothing. Equal rows are equal sets.
A document's component is the smallest doc_id reachable; rows without a doc_id are in no component but their class's.
A very long text is one set of any size, verified like others. An empty table gives no row. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from featherline.llm.connected import components
from featherline.llm.groups import first_reached, fixed, pairs, starts, whole_groups
from featherline.llm.spans import LOWER, SPACE_SEPARATED, Hashes, mix, pieces, shingles, text_buffer, words
from featherline.llm.tasks import staged, tidy

SIZE, PERCENT, GROUPS, LEAF = 4, 85, 32, 32
#: Classes of a candidate group, and shingles of a compared one, that a part of a block may have.
PART_ROWS, PART_SHINGLES = 4096, 4_000_000
FEW = 32


def allowed(size: np.ndarray) -> np.ndarray:
    """Shingles by which a set may differ from any that it links with."""
    return (100 - PERCENT) * size // PERCENT


def sets_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """Distinct shingle hashes of every row, sorted by row and hash, their rows, and the number of rows."""
    data, offsets = text_buffer(column)
    data = LOWER[data]
    start, end, row = words(data, offsets, SPACE_SEPARATED)
    n = len(offsets) - 1
    found, at = shingles(Hashes(data).of(start, end), row, n, SIZE)
    order = np.lexsort((found, at))
    found, at = found[order], at[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (at[1:] != at[:-1])
    return found[new], at[new], n


def names_of(found: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of parts that a set shares with any set it may link with, and the row of each name, sorted by row."""
    names, rows = [], []
    octave = np.floor(np.log2(np.maximum(size, 1))).astype(np.int64)
    differs = allowed(size)
    for step in (0, 1):
        level = octave + step
        meets = (differs > 0) & ((step == 0) | (size * 100 // PERCENT >= (1 << level)))
        most = allowed((2 << level) - 1)
        parts = (most + 4 + most // 4).astype(np.uint64)
        held = meets[at]
        value, row = found[held], at[held]
        if not len(value):
            continue
        part = (mix(value + np.uint64(77)) % parts[row]).astype(np.int64)
        order = np.lexsort((part, row))
        value, row, part = value[order], row[order], part[order]
        new = np.ones(len(value), bool)
        new[1:] = (part[1:] != part[:-1]) | (row[1:] != row[:-1])
        begin = np.flatnonzero(new)
        count = np.diff(np.append(begin, len(value)))
        name = np.add.reduceat(mix(value + np.uint64(991)), begin)
        of, part = row[begin], part[begin]
        name = mix(name + mix((level[of].astype(np.uint64) << np.uint64(40)) + part.astype(np.uint64)) + count.astype(np.uint64))
        order = np.lexsort((name, -count, of))
        of, name = of[order], name[order]
        place = np.arange(len(of)) - np.searchsorted(of, of)
        kept = place <= differs[of]
        names.append(name[kept])
        rows.append(of[kept])
        sparse = np.flatnonzero(meets & (np.bincount(of, minlength=len(size)) <= differs))
        names.append(mix(level[sparse].astype(np.uint64) + np.uint64(123_457)))
        rows.append(sparse)
    if not names:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    names, rows = np.concatenate(names), np.concatenate(rows)
    order = np.argsort(rows, kind="stable")
    return names[order], rows[order]


def digests(found: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of every row's set, as signed integers; zero for an empty one."""
    s1, s2 = np.zeros(len(size), np.uint64), np.zeros(len(size), np.uint64)
    filled = np.flatnonzero(size)
    if len(filled):
        first = (np.cumsum(size) - size)[filled]
        s1[filled] = mix(np.add.reduceat(mix(found + np.uint64(3)), first) + size[filled].astype(np.uint64))
        s2[filled] = mix(np.add.reduceat(mix(found ^ np.uint64(0x5555555555555555)), first))
    return s1.view(np.int64), s2.view(np.int64)


def may_link(shared: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Whether ``shared`` shingles are enough for two sets of ``total`` shingles together."""
    return (100 + PERCENT) * shared >= PERCENT * total


class RTree:
    """Nodes over points, split at the median of the widest coordinate, with the largest counts of each."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.points, self.sizes = points.astype(np.int64), sizes.astype(np.int64)
        self.order = np.argsort(self.sizes, kind="stable")
        self.nodes: list[tuple[int, int, int, int, np.ndarray, int, int]] = []
        self._build(0, len(sizes))

    def _build(self, begin: int, end: int) -> int:
        at = len(self.nodes)
        self.nodes.append(None)
        rows = self.order[begin:end]
        held = self.points[rows]
        left = right = -1
        most, least, largest = held.max(axis=0), int(self.sizes[rows].min()), int(self.sizes[rows].max())
        if end - begin > LEAF:
            # Sizes count as one more coordinate: sets of unlike size cannot link.
            spread = np.append(most - held.min(axis=0), (largest - least) / 4)
            widest = int(spread.argmax())
            values = self.sizes[rows] if widest == held.shape[1] else held[:, widest]
            middle = (end - begin) // 2
            self.order[begin:end] = rows[np.argpartition(values, middle)]
            left, right = self._build(begin, begin + middle), self._build(begin + middle, end)
        self.nodes[at] = (begin, end, left, right, most, least, largest)
        return at

    def candidates(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of rows (each once) that the bounds leave, a leaf at a time."""
        place = np.empty(len(self.order), np.int64)
        place[self.order] = np.arange(len(self.order))
        stack = [(0, self.order)]
        while stack:
            at, asking = stack.pop()
            begin, end, left, right, most, least, largest = self.nodes[at]
            mine = self.sizes[asking]
            # A pair is met at the row that comes later in the order.
            fits = (place[asking] < end) & (100 * mine >= PERCENT * least) & (100 * largest >= PERCENT * mine)
            asking, mine = asking[fits], mine[fits]
            asking = asking[may_link(np.minimum(self.points[asking], most).sum(axis=1), mine + least)]
            if not len(asking):
                continue
            if left >= 0:
                stack += [(left, asking), (right, asking)]
                continue
            rows = self.order[begin:end]
            for first in range(0, len(asking), 1024):
                some = asking[first:first + 1024]
                shared = np.minimum(self.points[some][:, None, :], self.points[rows][None, :, :]).sum(axis=2)
                good = may_link(shared, self.sizes[some][:, None] + self.sizes[rows]) & (place[some][:, None] < place[rows])
                a, b = np.nonzero(good)
                if len(a):
                    yield some[a], rows[b]


def bounded(points: np.ndarray, sizes: np.ndarray, begin: np.ndarray) -> Iterator[tuple[int, Iterator[tuple[np.ndarray, np.ndarray]]]]:
    """(row at which a group begins, candidate pairs) for every group; few rows are one leaf."""
    total = len(sizes)
    for first, end in zip(begin, np.append(begin[1:], total)):
        yield int(first), RTree(points[first:end], sizes[first:end]).candidates()


def _facts(docs: DataFrame, digest: bool = False) -> DataFrame:
    told = ["digest"] if digest else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "_text"):
                found, at, n = sets_of(piece.column("_text"))
                size = np.bincount(at, minlength=n)
                names, rows = names_of(found, at, size)
                s1, s2 = digests(found, size)
                group = (mix(found + np.uint64(5)) % np.uint64(GROUPS)).astype(np.int64)
                points = np.bincount(at * GROUPS + group, minlength=n * GROUPS).astype(np.int32).reshape(n, GROUPS)
                bounds = np.searchsorted(rows, np.arange(n + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    piece.column("doc_id"), pa.array(size.astype(np.int64)), pa.array(s1), pa.array(s2),
                    pa.array([p.tobytes() for p in points], pa.binary()), pa.ListArray.from_arrays(pa.array(bounds), pa.array(names.view(np.int64))),
                    *[piece.column(c) for c in told]], names=["doc_id", "n", "s1", "s2", "point", "names", *told])

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("_text"),
                       *[F.md5(F.col("text").cast("binary")).alias(c) for c in told])
    return read.mapInArrow(tidy(run), "doc_id long, n long, s1 long, s2 long, point binary, names array<long>" + (", digest string" if told else ""))


def _cut(rows: DataFrame, key: str, weight, limit: int) -> DataFrame:
    """Rows with parts: a row of a group that is over ``limit`` goes to a block with every part of the group."""
    sums = staged(rows.groupBy(F.col(key).alias("_g")).agg(F.sum(weight).alias("_w")).select(
        "_g", F.ceil(F.col("_w") / F.lit(limit)).cast("int").alias("cuts")).where("cuts > 1"), "cuts")
    held = rows.join(sums, F.col(key) == F.col("_g"), "left").drop("_g")
    cuts = F.coalesce("cuts", F.lit(1))
    held = held.withColumn("mine", F.pmod(F.xxhash64("s1", F.lit(1)), cuts).cast("int")).withColumn(
        "_other", F.explode(F.sequence(F.lit(0), cuts - 1)))
    return held.withColumn("a", F.least("mine", "_other")).withColumn("b", F.greatest("mine", "_other")).drop("_other", "cuts")


def _candidates(classes: DataFrame, groups: DataFrame) -> DataFrame:
    """Spanning edges ``a, b`` (set hashes) of what the bounds leave within the candidate groups ``id, component``."""
    keys = ["component", "a", "b"]
    rows = _cut(classes.join(groups, F.col("s1") == F.col("id")).select("component", "s1", "n", "point"), "component", F.lit(1), PART_ROWS)
    blocks = rows.repartition(*keys).sortWithinPartitions(*keys, "s1")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, keys):
            nodes, sizes = table.column("s1").to_numpy(), table.column("n").to_numpy()
            points = fixed(table.column("point"), np.int32, GROUPS)
            mine, a, b = (table.column(c).to_numpy() for c in ("mine", "a", "b"))
            begin = starts(table, keys)
            left, right = [], []
            size = np.diff(np.append(begin, len(nodes)))
            few = np.flatnonzero(np.repeat(size <= FEW, size))
            i, j = pairs(np.cumsum(size[size <= FEW]) - size[size <= FEW], len(few))
            i, j = few[i], few[j]
            good = may_link(np.minimum(points[i], points[j]).sum(axis=1), sizes[i] + sizes[j])
            left.append(i[good])
            right.append(j[good])
            for at in np.flatnonzero(size > FEW):
                first, end = begin[at], begin[at] + size[at]
                label = np.arange(size[at])
                for i, j in RTree(points[first:end], sizes[first:end]).candidates():
                    i, j = i[label[i] != label[j]], j[label[i] != label[j]]
                    if len(i):  # only what connects more is kept
                        left.append(i + first)
                        right.append(j + first)
                        reached = first_reached(np.concatenate([np.arange(len(label)), i]), np.concatenate([label, j]), len(label))
                        label = reached
            i, j = np.concatenate(left), np.concatenate(right)
            to = first_reached(i, j, len(nodes))
            some = to != np.arange(len(nodes))
            yield pa.RecordBatch.from_arrays([pa.array(nodes[some]), pa.array(nodes[to[some]])], names=["a", "b"])

    return blocks.mapInArrow(tidy(run), "a long, b long")


def _verified(docs: DataFrame, classes: DataFrame, groups: DataFrame) -> DataFrame:
    """Spanning links ``a, b`` (set hashes) within the groups ``id, component``, compared shingle by shingle."""
    asked = staged(classes.join(groups, F.col("s1") == F.col("id")).select(F.col("rep").alias("_rep"), "component", "s1", "s2", "n"), "asked")
    placed = _cut(asked, "component", F.col("n"), PART_SHINGLES)
    texts = asked.select("_rep", "s1", "s2").hint("merge").join(
        docs.select(F.col("doc_id").cast("long").alias("_doc"), F.coalesce("text", F.lit("")).alias("_text")), F.col("_rep") == F.col("_doc"))

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "_text"):
                found, at, n = sets_of(piece.column("_text"))
                bounds = np.searchsorted(at, np.arange(n + 1))
                s1, s2 = digests(found, np.diff(bounds))
                # An id that several texts share comes with each of them.
                meant = (s1 == piece.column("s1").to_numpy()) & (s2 == piece.column("s2").to_numpy())
                held = [found[bounds[k]:bounds[k + 1]].tobytes() for k in np.flatnonzero(meant)]
                yield pa.RecordBatch.from_arrays([pa.array(s1[meant]), pa.array(s2[meant]), pa.array(held, pa.binary())], names=["_s1", "_s2", "held"])

    sets = texts.select("s1", "s2", "_text").mapInArrow(tidy(shingled), "_s1 long, _s2 long, held binary").dropDuplicates(["_s1", "_s2"])
    keys = ["component", "a", "b"]
    rows = placed.join(sets, (F.col("s1") == F.col("_s1")) & (F.col("s2") == F.col("_s2"))).select(*keys, "mine", "s1", "n", "held")
    blocks = rows.repartition(*keys).sortWithinPartitions(*keys, "s1")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, keys, 2000):
            nodes, begin = table.column("s1").to_numpy(), starts(table, keys)
            data, offsets = text_buffer(table.column("held"))
            values = np.frombuffer(data.tobytes(), np.uint64)
            offsets = offsets // 8
            sizes = np.diff(offsets)
            group = (mix(values + np.uint64(5)) % np.uint64(GROUPS)).astype(np.int64)
            points = np.bincount(np.repeat(np.arange(len(nodes)), sizes) * GROUPS + group, minlength=len(nodes) * GROUPS).reshape(-1, GROUPS)
            a, b = [], []
            for first, candidates in bounded(points, sizes, begin):
                label: np.ndarray | None = None
                for i, j in candidates:
                    if label is None:
                        count = begin[np.searchsorted(begin, first) + 1] - first if first != begin[-1] else len(nodes) - first
                        label = np.arange(count)
                    while len(i):
                        open_pairs = label[i] != label[j]
                        i, j = i[open_pairs], j[open_pairs]
                        if not len(i):
                            break
                        # One pair per step for every two parts that are still apart.
                        x, y = int(i[0]), int(j[0])
                        p, q = values[offsets[first + x]:offsets[first + x + 1]], values[offsets[first + y]:offsets[first + y + 1]]
                        shared = len(np.intersect1d(p, q, assume_unique=True))
                        if may_link(shared, len(p) + len(q)):
                            a.append(nodes[first + x])
                            b.append(nodes[first + y])
                            label[label == label[y]] = label[x]
                        i, j = i[1:], j[1:]
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return blocks.mapInArrow(tidy(compare), "a long, b long")


def jaccard_join(docs: DataFrame, digest: bool = False) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``doc_id, text``; with ``digest`` the MD5 of its text too."""
    told = ["digest"] if digest else []
    facts = staged(_facts(docs, digest), "shingle-facts")
    classes = staged(facts.where("n > 0").groupBy("s1", "s2", "n", "point").agg(F.min("doc_id").alias("rep")), "shingle-classes")
    named = facts.select("s1", F.explode("names").alias("name"))
    shared = staged(named.groupBy("name").agg(F.min("s1").alias("least"), F.max("s1").alias("most")).where("least < most").select(
        F.col("name").alias("_name"), "least"), "shared-names")
    # Merged at every size: no table here has a bound that would let it be broadcast.
    edges = named.join(shared.hint("merge"), F.col("name") == F.col("_name")).select(F.col("s1").alias("a"), F.col("least").alias("b")).where("a <> b").distinct()
    near = components(_candidates(classes, components(edges)))
    links = staged(_verified(docs, classes, near), "shingle-links")
    linked = components(links)
    # The component's smallest document, over the classes it has.
    of_class = classes.join(linked, F.col("s1") == F.col("id"), "left").select("s1", "s2", "n", "rep", F.coalesce("component", "s1").alias("component"))
    smallest = of_class.groupBy("component").agg(F.min("rep").alias("smallest"))
    named_classes = staged(of_class.join(smallest, "component").select(
        F.col("s1").alias("_s1"), F.col("s2").alias("_s2"), F.col("n").alias("_n"), "smallest"), "shingle-components")
    return facts.select("doc_id", "n", "s1", "s2", *told).join(
        named_classes, (F.col("s1") == F.col("_s1")) & (F.col("s2") == F.col("_s2")) & (F.col("n") == F.col("_n")), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("smallest", "doc_id").alias("component_id"), *told)
