"""Vector columns: Spark SQL views of them, and numpy views of their Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, functions as F, types as T

# Arrow layout of Spark's vector type: type 0 is sparse, 1 is dense.
VECTOR_ARROW = pa.struct(
    [
        pa.field("type", pa.int8(), nullable=False),
        pa.field("size", pa.int32()),
        pa.field("indices", pa.list_(pa.field("element", pa.int32(), nullable=False))),
        pa.field("values", pa.list_(pa.field("element", pa.float64(), nullable=False))),
    ]
)


def vector_of(*columns: Column | str) -> Column:
    """Dense vector made of numeric columns, in order."""
    return array_to_vector(F.array(*[F.col(c).cast("double") if isinstance(c, str) else c for c in columns]))


def from_array(column: Column | str) -> Column:
    """Dense vector made of a numeric array column."""
    column = F.col(column) if isinstance(column, str) else column
    return array_to_vector(column.cast("array<double>"))


def to_array(column: Column | str) -> Column:
    return vector_to_array(F.col(column) if isinstance(column, str) else column)


def vector_size(features: Column) -> Column:
    """Length of a dense or sparse vector."""
    raw = F.unwrap_udt(features)
    return F.when(raw["type"] == 0, raw["size"]).otherwise(F.size(raw["values"]))


def lean(features: Column) -> Column:
    """A vector column as a plain struct without null fields, to be handed to Python tasks.

    Spark's Arrow writer goes back over the whole batch for every null list, and a dense vector has
    one; empty lists cost nothing. The numpy readers here take either form.
    """
    raw = F.unwrap_udt(features)
    fields = F.struct(
        raw["type"].alias("type"),
        F.coalesce(raw["size"], F.lit(0)).alias("size"),
        F.coalesce(raw["indices"], F.array().cast("array<int>")).alias("indices"),
        raw["values"].alias("values"),
    )
    return F.when(features.isNotNull(), fields)


def lean_matrix(features: Column) -> Column:
    """The same for a matrix column."""
    raw = F.unwrap_udt(features)
    empty = F.array().cast("array<int>")
    fields = F.struct(
        *[raw[name].alias(name) for name in ("type", "numRows", "numCols")],
        F.coalesce(raw["colPtrs"], empty).alias("colPtrs"),
        F.coalesce(raw["rowIndices"], empty).alias("rowIndices"),
        *[raw[name].alias(name) for name in ("values", "isTransposed")],
    )
    return F.when(features.isNotNull(), fields)


LEAN = (
    T.StructType()
    .add("type", T.ByteType())
    .add("size", T.IntegerType())
    .add("indices", T.ArrayType(T.IntegerType()))
    .add("values", T.ArrayType(T.DoubleType()))
)


def full(column: pa.StructArray) -> pa.StructArray:
    """A lean column in the layout of vectors again, with nulls where dense rows have no indices."""
    dense = pc.equal(column.field("type"), 1)
    size = pc.if_else(dense, pa.scalar(None, pa.int32()), column.field("size"))
    indices = column.field("indices")
    indices = pc.if_else(dense, pa.scalar(None, indices.type), indices).cast(VECTOR_ARROW.field("indices").type)
    values = column.field("values").cast(VECTOR_ARROW.field("values").type)
    return pa.StructArray.from_arrays([column.field("type"), size, indices, values], fields=list(VECTOR_ARROW),
                                      mask=column.is_null())


def float32(column: Column) -> Column:
    """The value after a trip through 32 bits."""
    return column.cast("float").cast("double")


def list_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Flat values and per-row lengths of a list column (a null list counts as empty)."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat, lengths


def starts_of(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(lengths)[:-1])).astype(np.int64) if len(lengths) else lengths


def to_matrix(column: pa.Array, width: int | None = None) -> np.ndarray:
    """Rows of an Arrow vector column (or numeric list column) as a 2-d float64 array."""
    if len(column) == 0:
        return np.empty((0, width or 0))
    if column.null_count:
        raise ValueError("null vector")
    if pa.types.is_list(column.type) or pa.types.is_large_list(column.type):
        flat, lengths = list_parts(column)
        sparse = np.zeros(len(column), dtype=bool)
        sizes = lengths
        indices = index_lengths = None
    else:
        sparse = column.field("type").to_numpy(zero_copy_only=False) == 0
        flat, lengths = list_parts(column.field("values"))
        sizes = np.where(sparse, column.field("size").fill_null(0).to_numpy(zero_copy_only=False), lengths)
        indices, index_lengths = list_parts(column.field("indices"))
    width = int(sizes[0]) if width is None else width
    if (sizes != width).any():
        raise ValueError(f"vectors of size {width} expected")
    if not sparse.any():
        return flat.reshape(len(column), width).astype(np.float64, copy=False)
    matrix = np.zeros((len(column), width))
    rows = np.repeat(np.arange(len(column)), lengths)
    within = np.arange(len(flat)) - np.repeat(starts_of(lengths), lengths)
    positions = within
    entry_sparse = np.repeat(sparse, lengths)
    positions[entry_sparse] = indices[np.repeat(sparse, index_lengths)]
    matrix[rows, positions] = flat
    return matrix


def dense_column(matrix: np.ndarray) -> pa.StructArray:
    """A 2-d array as an Arrow column of dense vectors."""
    count, width = matrix.shape
    offsets = np.arange(0, count * width + 1, width, dtype=np.int32) if width else np.zeros(count + 1, np.int32)
    values = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(matrix, np.float64).ravel()))
    return pa.StructArray.from_arrays(
        [
            pa.array(np.ones(count, np.int8)),
            pa.nulls(count, pa.int32()),
            pa.nulls(count, VECTOR_ARROW.field("indices").type),
            values.cast(VECTOR_ARROW.field("values").type),
        ],
        fields=list(VECTOR_ARROW),
    )


def sparse_column(sizes: np.ndarray, lengths: np.ndarray, indices: np.ndarray, values: np.ndarray) -> pa.StructArray:
    """Flat sparse entries as an Arrow column of sparse vectors."""
    offsets = pa.array(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32))
    return pa.StructArray.from_arrays(
        [
            pa.array(np.zeros(len(sizes), np.int8)),
            pa.array(sizes.astype(np.int32)),
            pa.ListArray.from_arrays(offsets, pa.array(indices.astype(np.int32))).cast(VECTOR_ARROW.field("indices").type),
            pa.ListArray.from_arrays(offsets, pa.array(values.astype(np.float64))).cast(VECTOR_ARROW.field("values").type),
        ],
        fields=list(VECTOR_ARROW),
    )


@F.arrow_udf(VectorUDT())
def _as_vector(raw: pa.Array) -> pa.Array:
    return raw


def from_struct(size: Column, indices: Column, values: Column) -> Column:
    """Sparse vector column from a size, ascending 0-based indices and their values."""
    return _as_vector(
        F.struct(
            F.lit(0).cast("tinyint").alias("type"),
            size.cast("int").alias("size"),
            indices.cast("array<int>").alias("indices"),
            values.cast("array<double>").alias("values"),
        )
    )
