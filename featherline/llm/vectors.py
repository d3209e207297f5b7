"""Vectors of a table, checked natively, and cosines in double precision that do not depend on blocks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F


def usable(vector: Column) -> Column:
    """True for a vector that has a direction: no null or non-finite component, not all zero."""
    wide = vector.cast("array<double>")
    fine = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(fine & F.exists(wide, lambda x: x != 0), F.lit(False))


def packed(vector: Column) -> Column:
    """The components as array<double>; tasks read it with :func:`matrix`."""
    return vector.cast("array<double>")


def matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a list column, those shorter than the longest filled up with zeros, and their lengths."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    lengths = np.diff(column.offsets.to_numpy())
    width = int(lengths.max(initial=0))
    if (lengths == width).all():
        return values.reshape(len(column), width), lengths
    found = np.zeros((len(column), width))
    found[np.arange(width) < lengths[:, None]] = values
    return found, lengths


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, in a way that neither overflows nor loses tiny vectors."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each pair of rows; summed per row, so equal vectors give equal results in any block."""
    scale = np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1))
    plain = (a * b).sum(axis=1) / np.where(scale > 0, scale, 1.0)
    odd = ~np.isfinite(scale) | (scale < 1e-280)
    if odd.any():
        plain[odd] = (unit(a[odd]) * unit(b[odd])).sum(axis=1)
    return plain
