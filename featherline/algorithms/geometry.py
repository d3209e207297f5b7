"""Distances and projections of vectors, over Arrow batches inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, functions as F, types as T

from featherline.functions import vectors

# Numbers a dense block of rows may hold inside a task.
BLOCK_NUMBERS = 8_000_000
NEAREST = T.StructType([T.StructField("distance", T.DoubleType()), T.StructField("cluster", T.DoubleType())])


def _blocks(column: pa.Array, width: int):
    """Dense blocks of a vector column, bounded in size."""
    step = max(1, BLOCK_NUMBERS // max(width, 1))
    for begin in range(0, len(column), step):
        yield vectors.to_matrix(column.slice(begin, step), width)


def nearest(features: Column, centers: np.ndarray) -> Column:
    """``struct<distance, cluster>`` of the closest center; equal distances go to the lower number."""
    centers = np.ascontiguousarray(centers, float)

    @F.arrow_udf(NEAREST)
    def find(column: pa.Array) -> pa.Array:
        distances, clusters = [], []
        for block in _blocks(column, centers.shape[1]):
            best = np.full(len(block), np.inf)
            chosen = np.zeros(len(block))
            for number, center in enumerate(centers):
                difference = block - center
                squared = np.einsum("ij,ij->i", difference, difference)
                closer = squared < best
                best[closer] = squared[closer]
                chosen[closer] = number
            distances.append(np.sqrt(best))
            clusters.append(chosen)
        columns = [pa.array(np.concatenate(c) if c else np.empty(0)) for c in (distances, clusters)]
        return pa.StructArray.from_arrays(columns, names=["distance", "cluster"])

    return find(vectors.lean(features))


def project(features: Column, components: np.ndarray, mean: np.ndarray | None = None) -> Column:
    """The vector, less ``mean``, in the coordinates of ``components`` (one column each)."""
    components = np.ascontiguousarray(components, float)
    shift = None if mean is None else np.asarray(mean, float) @ components

    @F.arrow_udf(VectorUDT())
    def find(column: pa.Array) -> pa.Array:
        blocks = [block @ components for block in _blocks(column, components.shape[0])]
        matrix = np.concatenate(blocks) if blocks else np.empty((0, components.shape[1]))
        return vectors.dense_column(matrix if shift is None else matrix - shift)

    return find(vectors.lean(features))
