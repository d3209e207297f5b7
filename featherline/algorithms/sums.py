"""Arrays of numbers summed over the rows of a table, each task sending one piece per array."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from featherline.functions import vectors

#: Entries of vectors that are worked on at a time.
MOST = 200_000


class Entries:
    """Vectors of a batch as flat entries: row, place and value; zeros are left out."""

    def __init__(self, column: pa.Array):
        values, lengths = vectors.list_parts(column.field("values"))
        indices, index_lengths = vectors.list_parts(column.field("indices"))
        sparse = column.field("type").to_numpy(zero_copy_only=False) == 0
        row = np.repeat(np.arange(len(column)), lengths)
        place = np.arange(len(values)) - np.repeat(vectors.starts_of(lengths), lengths)
        place[np.repeat(sparse, lengths)] = indices[np.repeat(sparse, index_lengths)]
        some = values != 0
        self.n, self.row, self.place, self.value = len(column), row[some], place[some].astype(np.int64), values[some].astype(float)
        self.total = np.bincount(self.row, self.value, self.n)

    def times(self, matrix: np.ndarray) -> np.ndarray:
        """Each row times a matrix with a row per place."""
        columns = [np.bincount(self.row, self.value * matrix[self.place, c], self.n) for c in range(matrix.shape[1])]
        return np.stack(columns, axis=1) if columns else np.zeros((self.n, 0))

    def parts(self) -> Iterator[Entries]:
        """Stretches of whole rows with about ``MOST`` entries."""
        begin = 0
        ends = np.cumsum(np.bincount(self.row, minlength=self.n))
        while begin < self.n:
            end = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + MOST, "right")))
            yield self.between(begin, end)
            begin = end

    def between(self, begin: int, end: int) -> Entries:
        """The rows from ``begin`` up to ``end``."""
        part = object.__new__(Entries)
        first, last = np.searchsorted(self.row, (begin, end)).tolist()
        part.n, part.row, part.place, part.value, part.total = end - begin, self.row[first:last] - begin, self.place[first:last], self.value[first:last], self.total[begin:end]
        return part


def summed(rows: DataFrame, add, shapes: list[tuple[int, ...]], size: int) -> list[np.ndarray]:
    """Sums over all rows of the arrays that ``add(entries)`` gives for ``size`` rows; each task sends one piece of numbers per array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(shape) for shape in shapes]
        for batch in batches:
            for begin in range(0, batch.num_rows, size):
                for total, some in zip(sums, add(Entries(batch.column(0).slice(begin, size)))):
                    total += some
        yield pieces(sums)

    return merged(rows.mapInArrow(run, PIECES), shapes)


#: What a task sends: an array's number and its numbers.
PIECES = "k int, held binary"


def pieces(sums: list[np.ndarray]) -> pa.RecordBatch:
    """A task's arrays, to be added to those of other tasks."""
    return pa.RecordBatch.from_arrays([pa.array(range(len(sums)), pa.int32()), pa.array([np.asarray(s, float).tobytes() for s in sums], pa.binary())], names=["k", "held"])


def merged(told: DataFrame, shapes: list[tuple[int, ...]]) -> list[np.ndarray]:
    """The sums of the pieces of all tasks; zeros where no task sent any."""

    def merge(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(v.as_py()) for v in table.column("held"))
        return pa.table({"k": table.column("k")[:1], "held": pa.array([total.tobytes()], pa.binary())})

    # Sums meet in two steps, so no task adds up more than a few dozen pieces.
    dealt = told.withColumn("part", F.spark_partition_id() % 32)
    once = dealt.groupBy("k", "part").applyInArrow(lambda t: merge(t.drop(["part"])), PIECES)
    held = {r.k: np.frombuffer(bytes(r.held)) for r in once.groupBy("k").applyInArrow(merge, PIECES).collect()}
    return [held.get(k, np.zeros(int(np.prod(shape)))).reshape(shape) for k, shape in enumerate(shapes)]
