"""Vectors of whole numbers, packed into blocks of rows in as few bytes as they take."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

from featherline.llm.vectors import matrix

#: Components beyond this count as this: the integers stay in a long, and their sums in 38 digits.
LARGEST = 2.0 ** 62
#: Doubles hold integers exactly below this.
EXACT = 2.0 ** 53
LONG = (1 << 63) - 1


def complete(vector: Column) -> Column:
    """True for a vector without a null or non-finite component."""
    return F.coalesce(F.forall(vector.cast("array<double>"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))), F.lit(False))


def floors(column: pa.Array, scale: float) -> np.ndarray:
    """floor(scale * x) of every component, as doubles; shorter rows are filled up with zeros."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(scale * matrix(column)[0]), -LARGEST, LARGEST)


def narrow(x: np.ndarray) -> tuple[str, bytes]:
    """The numpy type that holds the integers ``x``, and them in it."""
    most = np.abs(x).max(initial=0)
    kind = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<f8"
    return kind, x.astype(kind).tobytes()


def wide(held: bytes, kind: str, width: int, rows: int) -> np.ndarray:
    """What :func:`narrow` packed, as doubles."""
    return np.frombuffer(held, kind).reshape(rows, width).astype(np.float64)


def whole(x: np.ndarray) -> np.ndarray:
    """The same integers as Python's, which have no bound."""
    return np.array([int(v) for v in x.ravel()], dtype=object).reshape(x.shape)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of ``a`` with those of ``b``, exact, as long; beyond a long they are its last value."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(width, 1) < EXACT:
        return (a @ b.T).astype(np.int64)
    found = whole(a) @ whole(b).T
    return np.clip(found, -LONG, LONG).astype(np.int64)


def small(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether doubles hold every squared distance between rows of ``x`` and of ``y`` exactly."""
    far = np.abs(x).max(initial=0) + np.abs(y).max(initial=0)
    return far * far * max(x.shape[1], 1) < EXACT
