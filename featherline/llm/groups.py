"""Groups of rows that a task reads in order, many small ones at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

ROWS = 20_000


def starts(table: pa.Table | pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """Rows at which a new value of ``keys`` begins; ``keys`` are integers without nulls."""
    n = table.num_rows
    new = np.zeros(n, bool)
    new[:1] = True
    for key in keys:
        held = table.column(key)
        held = (held.combine_chunks() if isinstance(held, pa.ChunkedArray) else held).to_numpy(zero_copy_only=False)
        new[1:] |= held[1:] != held[:-1]
    return np.flatnonzero(new)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = ROWS) -> Iterator[pa.Table]:
    """Tables of whole groups, from batches that come sorted by ``keys``; a table has about ``rows`` rows or one group."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        count += batch.num_rows
        if count < rows:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        last = int(starts(table, keys)[-1])
        if last:
            yield table.slice(0, last)
            table = table.slice(last)
        held = table.to_batches()
        count = table.num_rows
    if count:
        yield pa.Table.from_batches(held).combine_chunks()


def pairs(begin: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Every pair of rows within groups that begin at ``begin``; meant for groups of a bounded few rows."""
    size = np.diff(np.append(begin, total))
    end = np.repeat(begin + size, size)
    a, b = [], []
    for step in range(1, int(size.max(initial=1))):
        first = np.flatnonzero(np.arange(total) + step < end)
        a.append(first)
        b.append(first + step)
    empty = np.zeros(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (empty, empty)


def first_reached(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least row that each of n rows is connected with by the pairs a, b."""
    label = np.arange(n)
    while len(a):
        lower = label.copy()
        np.minimum.at(lower, a, label[b])
        np.minimum.at(lower, b, label[a])
        lower = np.minimum(lower, lower[lower])
        if (lower == label).all():
            break
        label = lower
    return label


def fixed(column: pa.ChunkedArray | pa.Array, kind, width: int) -> np.ndarray:
    """Binary values of one length as a matrix with ``width`` columns of numpy type ``kind``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, width), kind)
    joined = pc.cast(column, pa.large_binary())
    _, places, held = joined.buffers()
    offsets = np.frombuffer(places, np.int64, len(column) + 1, joined.offset * 8)
    return np.frombuffer(held, kind, count=len(column) * width, offset=int(offsets[0])).reshape(len(column), width)
