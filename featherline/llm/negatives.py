"""Hard negatives by a secondary sort: keys of anchor, falling score and id, read as a stream.

1. Every usable vector becomes integers; rows are packed into blocks of ``BLOCK_ROWS`` and written once, with a row
   number. Anchors are packed into blocks of ``ANCHOR_ROWS``, and every block of anchors meets every block of rows: one
   integer matrix product, of which a task keeps, anchor by anchor, only the first rows that could count of all the
   blocks it reads. Blocks meet in a Cartesian product of partitions: tasks read them where they were written, and neither the
   shuffle nor the driver holds a copy for each meeting. What is shuffled follows the anchors and the number of tasks, not the pairs.
2. Each kept pair is packed into one sortable binary key: anchor, falling score, kind (positives before negatives of
   the same score), rising id, row. Keys are repartitioned by anchor and sorted within their partition, which is a
   secondary sort; a task reads its partition as a stream. It holds the open windows of one anchor only, at most as
   many as there are positives.
3. A first stream takes each anchor's first positives. They open the windows ``[low% of score, high% of score]``;
   the blocks meet once more and keep the first negatives of each window. A second stream reads positives and
   negatives together: a positive opens its window, a negative goes to the windows it falls in, a window
   that is full or passed is closed. Of the blocks of one task the first rows of a window are all that the window can take
   from them, so nothing is lost.

Rows whose label or vector is null or that have a null or non-finite component take no part. A vector that is shorter
than another counts as filled up with zeros (an empty one scores 0 with all). Scores are exact; components beyond
2^62 count as 2^62 and scores beyond a long as the last long. Rows that repeat an id are rows of their own: an anchor's
other rows are all but itself, and of equal scores the smaller id comes first, rows without an id last. A positive with
a negative score has an empty window. Anchors without a positive or without a negative give no rows, nor does an
empty table. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from featherline.llm.integers import complete, floors, narrow, products, wide
from featherline.llm.tasks import tidy
from featherline.workspace import written

BLOCK_ROWS, ANCHOR_ROWS, TILE = 4096, 1024, 128
#: Blocks of anchors that a task meets its rows with, and holds the first rows of.
ANCHOR_BLOCKS = 4
#: Anchor, falling score, kind, whether the id is missing, id, row: fixed width, big-endian, so that bytes sort as the values do.
KEY = struct.Struct(">QQBBQQ")
POSITIVE, NEGATIVE = 0, 1
#: Turns signed 64-bit integers into unsigned ones of the same order.
FLIP = 1 << 63

BLOCK = "stretch int, rows array<long>, ids array<long>, labels array<long>, kind string, width int, v binary"
ANCHORS = "block int, anchors array<long>, anchor_ids array<long>, anchor_labels array<long>, anchor_kind string, anchor_width int, anchor_v binary"


def keys(anchor: np.ndarray, score: np.ndarray, kind: int, ids: np.ndarray, missing: np.ndarray, rows: np.ndarray) -> pa.Array:
    """The packed keys of pairs."""
    n = len(anchor)
    held = np.zeros(n, np.dtype([("a", ">u8"), ("s", ">u8"), ("k", "u1"), ("m", "u1"), ("i", ">u8"), ("r", ">u8")]))
    held["a"] = anchor.astype(np.int64).view(np.uint64) ^ np.uint64(FLIP)
    held["s"] = ~(score.astype(np.int64).view(np.uint64) ^ np.uint64(FLIP))
    held["k"], held["m"] = kind, missing
    held["i"] = np.where(missing, 0, ids).astype(np.int64).view(np.uint64) ^ np.uint64(FLIP)
    held["r"] = rows.astype(np.int64).view(np.uint64) ^ np.uint64(FLIP)
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(KEY.size), n, [None, pa.py_buffer(held.tobytes())]).cast(pa.binary())


def unpacked(key: bytes) -> tuple[int, int, int, int | None, int]:
    """(anchor, score, kind, id, row) of a key."""
    a, s, k, m, i, r = KEY.unpack(key)
    return a - FLIP, (s ^ (2 * FLIP - 1)) - FLIP, k, None if m else i - FLIP, r - FLIP


def bounds(score: int, low: int, high: int) -> tuple[int, int]:
    """The least and the largest integer n with low * score <= 100 * n <= high * score."""
    return -(-low * score // 100), high * score // 100


def first_of(scores: np.ndarray, fits: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Mask of the first ``most`` fitting columns of every row: by falling score, then by ``order``."""
    chosen, n = fits.copy(), scores.shape[1]
    many = np.flatnonzero(fits.sum(axis=1) > most)
    if not len(many):
        return chosen
    held = np.where(fits[many], scores[many], np.iinfo(np.int64).min)
    last = np.partition(held, n - most, axis=1)[:, n - most]
    chosen[many] &= held >= last[:, None]
    for row in many[chosen[many].sum(axis=1) > most]:  # several columns tie for the last place
        at = np.flatnonzero(chosen[row])
        ranked = at[np.lexsort((order[at], -scores[row, at]))]
        chosen[row, ranked[most:]] = False
    return chosen


def _longs(values: pa.Array) -> np.ndarray:
    return values.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


class Meeting:
    """A block of anchors and a block of rows, from one joined record; the block of rows may be that of the ``last`` meeting."""

    def __init__(self, batch: pa.RecordBatch, at: int, last: Meeting | None = None):
        def array(name: str) -> pa.Array:
            return batch.column(name)[at].values

        def vectors(prefix: str, rows: int) -> np.ndarray:
            kind, width = (batch.column(prefix + name)[at].as_py() for name in ("kind", "width"))
            return wide(batch.column(f"{prefix}v")[at].as_buffer(), kind, width, rows)

        self.anchors, self.anchor_labels = _longs(array("anchors")), _longs(array("anchor_labels"))
        self.a = vectors("anchor_", len(self.anchors))
        self.rows = _longs(array("rows"))
        if last is not None and last.rows[0] == self.rows[0]:  # a row number is in one block only
            self.labels, self.ids, self.missing, self.x, self.order = last.labels, last.ids, last.missing, last.x, last.order
            return
        self.labels, self.ids = _longs(array("labels")), _longs(array("ids"))
        self.missing = array("ids").is_null().to_numpy(zero_copy_only=False)
        self.x = vectors("", len(self.rows))
        ranked = np.lexsort((self.rows, self.ids, self.missing))
        self.order = np.empty(len(ranked), np.int64)  # of equal scores: smaller id, then row
        self.order[ranked] = np.arange(len(ranked))

    def tiles(self) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        """(anchors, scores, whether the labels are the same), few anchors at a time."""
        for begin in range(0, len(self.anchors), TILE):
            some = slice(begin, begin + TILE)
            yield some, products(self.a[some], self.x), self.anchor_labels[some, None] == self.labels


def meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Meeting, pa.RecordBatch, int]]:
    """The meetings of a task, each with the batch and the row it is from."""
    met = None
    for batch in batches:
        for at in range(batch.num_rows):
            met = Meeting(batch, at, met)
            yield met, batch, at


class First:
    """The first ``most`` rows met so far of each of an anchor's ``windows``, for a block of anchors."""

    def __init__(self, anchors: np.ndarray, windows: int, most: int):
        self.anchors, self.windows, self.most = anchors, windows, most
        #: Scores below which a row cannot count any more.
        self.floor = np.full((len(anchors), windows), np.iinfo(np.int64).min)
        empty = np.zeros(0, np.int64)
        self.held, self.waiting = [(empty, empty, empty.astype(bool), empty, empty)], 0

    def add(self, met: Meeting, some: slice, window: int, scores: np.ndarray, fits: np.ndarray) -> None:
        """The rows of a tile that fit a window."""
        i, j = np.nonzero(first_of(scores, fits, met.order, self.most))
        if len(i):
            self.held.append(((some.start + i) * self.windows + window, scores[i, j], met.missing[j], met.ids[j], met.rows[j]))
            self.waiting += len(i)

    def rest(self) -> None:
        """Leave out what cannot count, where much waits for it."""
        if self.waiting > 1000 + len(self.held[0][0]) // 4:
            self.cut()

    def cut(self) -> None:
        """Keep the first rows only."""
        place, score, missing, ids, rows = held = [np.concatenate(some) for some in zip(*self.held)]
        ranked = np.lexsort((rows, ids, missing, -score, place))
        of = place[ranked]
        rank = np.arange(len(of)) - np.searchsorted(of, of)
        full = rank == self.most - 1
        self.floor.reshape(-1)[of[full]] = score[ranked[full]]
        kept = ranked[rank < self.most]
        self.held, self.waiting = [tuple(some[kept] for some in held)], 0

    def told(self, kind: int) -> pa.RecordBatch:
        """The keys of the rows, each once for an anchor."""
        self.cut()
        place, score, missing, ids, rows = self.held[0]
        anchor = self.anchors[place // self.windows]
        ranked = np.lexsort((rows, anchor))
        new = np.ones(len(ranked), bool)
        new[1:] = (anchor[ranked][1:] != anchor[ranked][:-1]) | (rows[ranked][1:] != rows[ranked][:-1])
        once = ranked[new]
        return pa.RecordBatch.from_arrays([pa.array(anchor[once]), keys(anchor[once], score[once], kind, ids[once], missing[once], rows[once])],
                                          names=["anchor", "key"])


def blocks(vectors: DataFrame, label: Column, is_anchor: Column, scale: float) -> DataFrame:
    """Usable rows in blocks, each with its row number and whether it is an anchor."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), label.cast("long").alias("label"),
                          F.coalesce(is_anchor, F.lit(False)).alias("asks"), F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.where(F.col("label").isNotNull() & complete(F.col("v"))).select("*", F.monotonically_increasing_id().alias("row"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, BLOCK_ROWS):
                some = batch.slice(begin, BLOCK_ROWS)
                x = floors(some.column("v"), scale)
                kind, held = narrow(x)
                ends = pa.array([0, some.num_rows], pa.int32())
                lists = [pa.ListArray.from_arrays(ends, some.column(name)) for name in ("row", "id", "label", "asks")]
                yield pa.RecordBatch.from_arrays([*lists, pa.array([kind]), pa.array([x.shape[1]], pa.int32()), pa.array([held], pa.binary())],
                                                 names=["rows", "ids", "labels", "asks", "kind", "width", "v"])

    packed = rows.mapInArrow(tidy(pack), "rows array<long>, ids array<long>, labels array<long>, asks array<boolean>, kind string, width int, v binary")
    return written(packed, "vector-blocks")


def anchor_blocks(packed: DataFrame, n: int) -> DataFrame:
    """The anchors of the written blocks, dealt into ``n`` blocks of their own."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                asks = np.flatnonzero(batch.column("asks")[at].values.to_numpy(zero_copy_only=False))
                kind, width, v = (batch.column(name)[at].as_py() for name in ("kind", "width", "v"))
                lists = [batch.column(name)[at].values for name in ("rows", "ids", "labels")]
                x = wide(v, kind, width, len(lists[0]))[asks]
                yield pa.RecordBatch.from_arrays(
                    [*[held.take(pa.array(asks)) for held in lists], pa.array([r.tobytes() for r in x], pa.binary())], names=["row", "id", "label", "v"])

    def pack(table: pa.Table) -> pa.Table:
        held = [np.frombuffer(v.as_py(), np.float64) for v in table.column("v")]
        x = np.zeros((len(held), max(map(len, held))))
        for row, v in enumerate(held):
            x[row, :len(v)] = v
        kind, packed_v = narrow(x)
        ends = pa.array([0, len(held)], pa.int32())
        lists = [pa.ListArray.from_arrays(ends, table.column(name).combine_chunks()) for name in ("row", "id", "label")]
        return pa.table([table.column("block")[:1], *lists, pa.array([kind]), pa.array([x.shape[1]], pa.int32()), pa.array([packed_v], pa.binary())],
                        names=["block", "anchors", "anchor_ids", "anchor_labels", "anchor_kind", "anchor_width", "anchor_v"])

    singly = packed.where(F.exists("asks", lambda x: x)).mapInArrow(tidy(pick), "row long, id long, label long, v binary")
    dealt = singly.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(n)).cast("int"))
    return written(dealt.groupBy("block").applyInArrow(pack, ANCHORS), "anchor-blocks")


def _sorted(pairs: DataFrame) -> DataFrame:
    """The secondary sort: an anchor's pairs in one partition, in the order of their keys."""
    return pairs.repartition("anchor").sortWithinPartitions("key").select("key")


def hard_negatives(vectors: DataFrame, label: Column, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
                   scale: float = 256.0) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` from ``vec_id, embedding``.

    For the first ``positives`` rows of an anchor's label, the first ``negatives`` rows of other labels whose score is
    between ``low`` and ``high`` percent of the positive's.
    """
    if not 0 <= low <= high <= 100:
        raise ValueError("a window lies between 0 and 100 percent of its positive's score")
    packed = blocks(vectors, label, is_anchor, scale)
    n_anchors = packed.agg(F.sum(F.size(F.filter("asks", lambda x: x)))).first()[0] or 0
    n = max(1, -(-n_anchors // ANCHOR_ROWS))
    asked = anchor_blocks(packed, n)
    rows = packed.select("rows", "ids", "labels", "kind", "width", "v")

    def everywhere(asking: DataFrame) -> DataFrame:
        """Every block of rows beside every block of anchors, of which a task meets few."""
        return rows.crossJoin(asking.repartition(-(-n // ANCHOR_BLOCKS)).hint("shuffle_replicate_nl"))

    def nearest_same(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first: dict[int, First] = {}
        for met, _, _ in meetings(batches):
            held = first.setdefault(int(met.anchors[0]), First(met.anchors, 1, positives))
            for some, scores, same in met.tiles():
                held.add(met, some, 0, scores, same & (met.anchors[some, None] != met.rows) & (scores >= held.floor[some]))
            held.rest()
        for held in first.values():
            yield held.told(POSITIVE)

    def first_positives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, taken = None, 0
        for batch in batches:
            found = []
            for key in batch.column("key").to_pylist():
                of, score, *_ = unpacked(key)
                if of != anchor:
                    anchor, taken = of, 0
                taken += 1
                if taken <= positives:
                    found.append((of, score, key))
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.binary()))],
                                             names=["anchor", "score", "key"])

    pairs = "anchor long, key binary"
    leading = written(_sorted(everywhere(asked).mapInArrow(tidy(nearest_same), pairs)).mapInArrow(tidy(first_positives), "anchor long, score long, key binary"), "positives")

    # The windows of an anchor go into its block: an anchor has at most as many as it has positives.
    windows = leading.groupBy("anchor").agg(F.sort_array(F.collect_list("score"), False).alias("scores"))
    of_anchor = asked.select("block", F.explode("anchors").alias("anchor")).join(windows.hint("merge"), "anchor")
    of_block = of_anchor.groupBy("block").agg(F.collect_list(F.struct("anchor", "scores")).alias("windows"))
    opened = everywhere(written(asked.join(of_block.hint("merge"), "block"), "windows"))

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first: dict[int, tuple[First, np.ndarray]] = {}
        for met, batch, at in meetings(batches):
            if int(met.anchors[0]) not in first:
                scores_of = {w["anchor"]: w["scores"] for w in batch.column("windows")[at].as_py()}
                limits = np.tile(np.array([1, 0], np.int64), (len(met.anchors), positives, 1))  # empty windows
                for k, anchor in enumerate(met.anchors.tolist()):
                    for w, score in enumerate(scores_of.get(anchor, [])):
                        limits[k, w] = bounds(score, low, high)
                first[int(met.anchors[0])] = First(met.anchors, positives, negatives), limits
            held, limits = first[int(met.anchors[0])]
            for some, scores, same in met.tiles():
                for w in range(positives):
                    least, most = np.maximum(limits[some, w, 0], held.floor[some, w])[:, None], limits[some, w, 1, None]
                    held.add(met, some, w, scores, ~same & (scores >= least) & (scores <= most))
            held.rest()
        for held, _ in first.values():
            yield held.told(NEGATIVE)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, open_windows = None, []
        for batch in batches:
            found = []
            for key in batch.column("key").to_pylist():
                of, score, kind, i, _ = unpacked(key)
                if of != anchor:
                    anchor, open_windows = of, []
                if kind == POSITIVE:
                    open_windows.append([i, score, *bounds(score, low, high), 0])
                    continue
                for window in open_windows:
                    if window[2] <= score <= window[3] and window[4] < negatives:
                        window[4] += 1
                        found.append((of, window[0], window[4], i, window[1], score))
                open_windows = [w for w in open_windows if w[4] < negatives and w[2] <= score]
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], kind) for k, kind in enumerate(kinds)],
                                             names=["anchor", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])

    mined = _sorted(leading.select("anchor", "key").union(opened.mapInArrow(tidy(inside), pairs))).mapInArrow(
        tidy(emit), "anchor long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    names = asked.select(F.explode(F.arrays_zip("anchors", "anchor_ids")).alias("of")).select(F.col("of.anchors").alias("anchor"), F.col("of.anchor_ids").alias("anchor_id"))
    return mined.join(names.hint("merge"), "anchor").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
