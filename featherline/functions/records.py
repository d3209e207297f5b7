"""Record bytes of vectors and matrices as column functions over Arrow batches."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import MatrixUDT, VectorUDT
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from featherline.functions import vectors, wire



def _tensor_type(number: T.DataType) -> T.StructType:
    return (T.StructType().add("values", T.ArrayType(number)).add("keys", T.ArrayType(T.LongType()))
            .add("shape", T.ArrayType(T.LongType())))


# One field per kind of value; all but one are null.
VALUE = (
    T.StructType()
    .add("float32", _tensor_type(T.FloatType()))
    .add("float64", _tensor_type(T.DoubleType()))
    .add("int32", _tensor_type(T.IntegerType()))
    .add("bytes", T.StructType().add("value", T.ArrayType(T.BinaryType())).add("content_type", T.StringType()))
)
RECORD = (
    T.StructType()
    .add("features", T.MapType(T.StringType(), VALUE))
    .add("label", T.MapType(T.StringType(), VALUE))
    .add("uid", T.StringType())
    .add("metadata", T.StringType())
    .add("configuration", T.StringType())
)


def _matrix_tensors(column: pa.Array):
    """Row-major values, keys and shapes of a matrix column."""

    def number(name: str) -> np.ndarray:
        return column.field(name).to_numpy(zero_copy_only=False).astype(np.int64)

    rows, cols, transposed = number("numRows"), number("numCols"), number("isTransposed").astype(bool)
    sparse = number("type") == 0
    values, counts = vectors.list_parts(column.field("values"))
    within = np.arange(len(values)) - np.repeat(vectors.starts_of(counts), counts)
    # Dense entries held column by column move to their place row by row.
    turned = np.repeat(~sparse & ~transposed, counts)
    height, width = np.repeat(rows, counts)[turned], np.repeat(cols, counts)[turned]
    place = within[turned]
    source = np.arange(len(values))
    source[turned] += (place % width) * height + place // width - place
    # Sparse entries carry their minor index; how many lie between two pointers gives the major one.
    pointers, pointer_counts = vectors.list_parts(column.field("colPtrs"))
    minor, key_counts = vectors.list_parts(column.field("rowIndices"))
    steps = np.diff(pointers, append=0).astype(np.int64)
    last = np.cumsum(pointer_counts)[pointer_counts > 0] - 1
    steps[last] = 0
    position = np.arange(len(pointers)) - np.repeat(vectors.starts_of(pointer_counts), pointer_counts)
    major = np.repeat(position, steps)
    by_row = np.repeat(transposed, key_counts)
    keys = np.where(by_row, major, minor) * np.repeat(cols, key_counts) + np.where(by_row, minor, major)
    shapes = np.column_stack([rows, cols]).ravel()
    return values[source], counts, keys, key_counts, shapes, np.full(len(rows), 2, np.int64)


def _vector_tensors(column: pa.Array):
    """Values of a vector column; sparse rows also give keys and a shape."""
    sparse = column.field("type").to_numpy(zero_copy_only=False) == 0
    values, counts = vectors.list_parts(column.field("values"))
    indices, index_counts = vectors.list_parts(column.field("indices"))
    sizes = column.field("size").fill_null(0).to_numpy(zero_copy_only=False)
    keys = indices[np.repeat(sparse, index_counts)]
    return values, counts, keys, np.where(sparse, index_counts, 0), sizes[sparse], sparse.astype(np.int64)


def encode_batch(features: pa.Array, label: pa.Array | None = None, uid: pa.Array | None = None) -> wire.Ragged:
    """Record bytes of an Arrow batch. A null label leaves the label out; null features fail."""
    if features.null_count:
        raise ValueError("features must not be null")
    if not len(features):
        return wire.Ragged(np.empty(0, np.uint8), np.empty(0, np.int64))
    is_matrix = features.type.get_field_index("numRows") >= 0
    tensors = _matrix_tensors(features) if is_matrix else _vector_tensors(features)
    labels = has_label = uids = None
    if label is not None:
        has_label = label.is_valid().to_numpy(zero_copy_only=False)
        labels = label.cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False)
    if uid is not None:
        texts = uid.cast(pa.string()).fill_null("").cast(pa.binary())
        buffers = texts.buffers()
        offsets = np.frombuffer(buffers[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.empty(0, np.uint8)
        uids = wire.Ragged(data[offsets[0] : offsets[-1]], np.diff(offsets).astype(np.int64))
    return wire.encode_records(*tensors, labels=labels, has_label=has_label, uids=uids)


@F.arrow_udf(T.BinaryType())
def _encode_features(features: pa.Array) -> pa.Array:
    return wire.binary_array(encode_batch(features))


@F.arrow_udf(T.BinaryType())
def _encode_labeled(features: pa.Array, label: pa.Array) -> pa.Array:
    return wire.binary_array(encode_batch(features, label))


def record_bytes(features: Column, label: Column | None = None, matrix: bool = False) -> Column:
    """One record per row of vectors (or matrices). Values are narrowed to 32 bits; sparse ones keep keys and size."""
    raw = vectors.lean_matrix(features) if matrix else vectors.lean(features)
    return _encode_features(raw) if label is None else _encode_labeled(raw, label.cast("double"))


def _little_endian(number: Column) -> Column:
    digits = F.lpad(F.hex(number), 8, "0")
    return F.unhex(F.concat(*[F.substring(digits, at, 2) for at in (7, 5, 3, 1)]))


def frame(body: Column) -> Column:
    """Magic, length, body and zero padding to a multiple of 4, as an expression."""
    length = F.octet_length(body)
    magic = F.lit(wire.MAGIC.to_bytes(4, "little"))
    padding = F.unhex(F.repeat(F.lit("00"), F.pmod(-length, F.lit(wire.ALIGNMENT))))
    return F.concat(magic, _little_endian(length), body, padding)


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shared bytes, starts and lengths of a binary column without nulls."""
    if column.null_count:
        raise ValueError("null bytes")
    column = column.cast(pa.large_binary())
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.empty(0, np.uint8)
    return data, offsets[:-1], np.diff(offsets)


@F.arrow_udf(T.ArrayType(T.BinaryType()))
def _split(payloads: pa.Array) -> pa.Array:
    # Payloads lie end to end in the batch, so their frames are found in one go; each payload must
    # then begin where a frame begins.
    data, starts, lengths = _bytes_of(payloads)
    first = int(starts[0]) if len(starts) else 0
    stop = int(starts[-1] + lengths[-1]) if len(starts) else 0
    begin, size, _ = wire.frame_spans(data[first:stop])
    filled = lengths > 0
    heads = begin + first - 8
    at = np.searchsorted(heads, starts)
    if not np.isin(starts[filled], heads).all():
        raise ValueError("truncated frame")
    offsets = pa.array(np.append(at, len(heads)).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, wire.binary_array(wire.gather(data, begin + first, size)))


def split_frames(payload: Column) -> Column:
    """Bodies of the frames in a payload, in order; a wrong magic number or a cut frame fails."""
    return _split(payload)


def unframe(df: DataFrame, payload: str, body: str = "body") -> DataFrame:
    """One row per frame of ``payload``, with its position."""
    rest = [c for c in df.columns if c != payload]
    return df.select(*rest, F.posexplode(split_frames(F.col(payload))).alias("position", body))


def _numbers(raw: bytes, spans, dtype: str | None) -> list:
    joined = b"".join(raw[a:b] for a, b in spans)
    if dtype:
        return np.frombuffer(joined, dtype).tolist()
    return wire.decode_varints(np.frombuffer(joined, np.uint8))[0].tolist()


def _value(raw: bytes, arm: str | None, begin: int, stop: int) -> dict:
    value = dict.fromkeys(("float32", "float64", "int32", "bytes"))
    if arm in ("float32", "float64", "int32"):
        spans = wire.tensor_spans(raw, begin, stop)
        dtype = {"float32": "<f4", "float64": "<f8", "int32": None}[arm]
        numbers = _numbers(raw, spans["values"], dtype)
        if arm == "int32":
            numbers = [((n & 0xFFFFFFFF) ^ 0x80000000) - 0x80000000 for n in numbers]
        value[arm] = {"values": numbers, "keys": _numbers(raw, spans["keys"], None),
                      "shape": _numbers(raw, spans["shape"], None)}
    elif arm == "bytes":
        pieces, content = [], None
        for tag, a, b in wire._fields(raw, begin, stop):
            if tag == 0x0A:
                pieces.append(raw[a:b])
            elif tag == 0x12:
                content = raw[a:b].decode()
        value["bytes"] = {"value": pieces, "content_type": content}
    return value


def parse_body(raw: bytes) -> dict:
    """All of a record, as nested Python values in the layout of ``RECORD``."""
    entries = wire.record_entries(raw)
    record: dict = {}
    for side in ("features", "label"):
        named: dict = {}
        for name, arm, begin, stop in entries[side]:
            named.setdefault(name, _value(raw, arm, begin, stop))
        record[side] = list(named.items())
    for name in ("uid", "metadata", "configuration"):
        record[name] = raw[slice(*entries[name])].decode() if entries[name] else None
    return record


def record_arrow_type() -> pa.DataType:
    return to_arrow_type(RECORD)


@F.arrow_udf(RECORD)
def _parse(bodies: pa.Array) -> pa.Array:
    return pa.array([parse_body(b) for b in bodies.to_pylist()], record_arrow_type())


def parse_record(body: Column) -> Column:
    """The whole record as nested columns, every tensor kind included."""
    return _parse(body)


def _offsets(counts: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(counts))).astype(np.int32)


def read_tensor(body: Column, name: str = "values", side: str = "features") -> Column:
    """One float32 tensor of a record as ``struct<values, keys, shape>``; null where it is missing."""
    wanted = [(side, name)]

    @F.arrow_udf(_tensor_type(T.FloatType()))
    def read(bodies: pa.Array) -> pa.Array:
        (batch,) = wire.decode_tensors(*_bytes_of(bodies), wanted)
        lists = [
            pa.ListArray.from_arrays(pa.array(_offsets(part.counts)), pa.array(part.flat().astype(kind)))
            for part, kind in ((batch.values, np.float32), (batch.keys, np.int64), (batch.shapes, np.int64))
        ]
        return pa.StructArray.from_arrays(lists, names=["values", "keys", "shape"], mask=pa.array(~batch.present))

    return read(body)


def _check_field(field: T.StructField) -> None:
    if not isinstance(field.dataType, (T.DoubleType, VectorUDT)):
        raise ValueError(f"column {field.name} must be a double or a vector")


def tensor_column(batch: wire.TensorBatch, wanted: T.DataType, name: str) -> pa.Array:
    """Tensors as the declared type: a double needs one value, a vector any number above none."""
    if not batch.present.all():
        raise ValueError(f"record has no entry {name}")
    if (batch.values.counts == 0).any():
        raise ValueError(f"entry {name} holds no values")
    if isinstance(wanted, T.DoubleType):
        if (batch.values.counts != 1).any():
            raise ValueError(f"entry {name} holds more than one value")
        return pa.array(batch.values.flat())
    return vector_column(batch)


def vector_column(batch: wire.TensorBatch) -> pa.StructArray:
    """Tensors as vectors; keys make a row sparse, and its shape must then be one number."""
    counts, key_counts, shape_counts = batch.values.counts, batch.keys.counts, batch.shapes.counts
    sparse = key_counts > 0
    if (shape_counts[sparse] != 1).any():
        raise ValueError("a sparse tensor needs a shape of one number to be a vector")
    if (key_counts[sparse] != counts[sparse]).any():
        raise ValueError("as many keys as values expected")
    # A record without values but with a size is an empty sparse vector.
    sparse = sparse | ((counts == 0) & (shape_counts == 1))
    sizes = np.zeros(len(counts), np.int64)
    sizes[sparse] = batch.shapes.flat()[vectors.starts_of(shape_counts)[sparse]]
    offsets = pa.array(_offsets(counts))
    values = pa.array(batch.values.flat())
    keys = pa.array(batch.keys.flat().astype(np.int32))
    index_lists = pa.ListArray.from_arrays(pa.array(_offsets(key_counts)), keys, mask=pa.array(~sparse))
    return pa.StructArray.from_arrays(
        [
            pa.array(np.where(sparse, 0, 1).astype(np.int8)),
            pa.array(sizes.astype(np.int32), mask=~sparse),
            index_lists.cast(vectors.VECTOR_ARROW.field("indices").type),
            pa.ListArray.from_arrays(offsets, values).cast(vectors.VECTOR_ARROW.field("values").type),
        ],
        fields=list(vectors.VECTOR_ARROW),
    )


def decode_outputs(body: Column, schema: T.StructType, keys: Sequence[str] | None = None) -> Column:
    """Named label tensors of a record as a struct of doubles and vectors.

    Entries are matched by ``keys`` in the order of the schema, or by the column names. The
    first entry of a name wins, other entries are ignored, and a missing one fails.
    """
    for field in schema:
        _check_field(field)
    keys = list(keys or schema.fieldNames())
    if len(keys) < len(schema):
        raise ValueError(f"{len(schema)} keys expected, got {len(keys)}")
    wanted = [("label", key) for key in keys[: len(schema)]]
    fields = list(schema)

    @F.arrow_udf(schema)
    def decode(bodies: pa.Array) -> pa.Array:
        batches = wire.decode_tensors(*_bytes_of(bodies), wanted)
        columns = [tensor_column(b, f.dataType, k[1]) for b, f, k in zip(batches, fields, wanted)]
        return pa.StructArray.from_arrays(columns, names=[f.name for f in fields])

    return decode(body)


def is_features_type(data_type: T.DataType) -> bool:
    """Vectors, matrices, or vectors as lean structs."""
    lean = isinstance(data_type, T.StructType) and data_type.fieldNames() == vectors.LEAN.fieldNames()
    return lean or isinstance(data_type, (VectorUDT, MatrixUDT))
