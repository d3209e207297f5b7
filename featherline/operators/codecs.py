"""The row encoders and response decoders that scoring accepts, besides a user's own."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F, types as T
from pyspark.ml.linalg import VectorUDT

from featherline.functions import records, text, wire
from featherline.operators.tables import require_columns


class LibSVMEncoder:
    content_type = text.TEXT_LIBSVM

    def __init__(self, label: str | None = "label", features: str = "features"):
        self.label, self.features = label, features

    def validate(self, schema: T.StructType) -> None:
        require_columns(schema, self.features, self.label)

    def encode(self) -> Column:
        return text.libsvm_line(F.col(self.features), F.col(self.label) if self.label else None)


class UnlabeledLibSVMEncoder(LibSVMEncoder):
    def __init__(self, features: str = "features"):
        super().__init__(None, features)


class CSVEncoder:
    content_type = text.TEXT_CSV

    def __init__(self, features: str = "features"):
        self.features = features

    def validate(self, schema: T.StructType) -> None:
        require_columns(schema, self.features)

    def encode(self) -> Column:
        return text.csv_line(F.col(self.features))


class RecordEncoder:
    content_type = text.RECORDS

    def __init__(self, features: str = "features"):
        self.features = features

    def validate(self, schema: T.StructType) -> None:
        require_columns(schema, self.features)

    def encode(self) -> Column:
        return records.frame(records.record_bytes(F.col(self.features)))


class RecordDecoder:
    """Named label tensors of framed records, typed by the given schema."""

    accepts = text.RECORDS

    def __init__(self, schema: T.StructType, keys: Sequence[str] | None = None):
        keys = list(keys or schema.fieldNames())
        if len(keys) < len(schema):
            raise ValueError(f"{len(schema)} keys expected, got {len(keys)}")
        self.schema = schema
        self.keys = keys[: len(schema)]

    def decode(self, body: bytes) -> pa.RecordBatch:
        data = np.frombuffer(body, np.uint8)
        starts, lengths, _ = wire.frame_spans(data)
        batches = wire.decode_tensors(data, starts, lengths, [("label", key) for key in self.keys])
        columns = [records.tensor_column(b, f.dataType, k) for b, f, k in zip(batches, self.schema, self.keys)]
        return pa.RecordBatch.from_arrays(columns, names=self.schema.fieldNames())


def _fields(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


def kmeans_decoder(distance: str = "distance_to_cluster", cluster: str = "closest_cluster") -> RecordDecoder:
    return RecordDecoder(_fields(**{distance: T.DoubleType(), cluster: T.DoubleType()}),
                         ["distance_to_cluster", "closest_cluster"])


def pca_decoder(projection: str = "projection") -> RecordDecoder:
    return RecordDecoder(_fields(**{projection: VectorUDT()}), ["projection"])


def topics_decoder(mixture: str = "topic_mixture") -> RecordDecoder:
    return RecordDecoder(_fields(**{mixture: VectorUDT()}), ["topic_mixture"])


def binary_decoder(score: str = "score", label: str = "predicted_label") -> RecordDecoder:
    return RecordDecoder(_fields(**{score: T.DoubleType(), label: T.DoubleType()}), ["score", "predicted_label"])


def multiclass_decoder(score: str = "score", label: str = "predicted_label") -> RecordDecoder:
    return RecordDecoder(_fields(**{score: VectorUDT(), label: T.DoubleType()}), ["score", "predicted_label"])


def regressor_decoder(score: str = "score") -> RecordDecoder:
    return RecordDecoder(_fields(**{score: T.DoubleType()}), ["score"])


class CSVDecoder:
    """One number per row, separated by commas."""

    accepts = text.TEXT_CSV

    def __init__(self, prediction: str = "prediction"):
        self.schema = T.StructType([T.StructField(prediction, T.DoubleType(), False)])

    def decode(self, body: bytes) -> pa.RecordBatch:
        numbers = [float(cell) for cell in body.decode().strip().split(",")]
        return pa.RecordBatch.from_arrays([pa.array(numbers, pa.float64())], names=self.schema.fieldNames())


class LibSVMDecoder:
    """A label and a sparse vector of fixed size per line."""

    accepts = text.TEXT_LIBSVM

    def __init__(self, dim: int, label: str = "label", features: str = "features"):
        if dim < 0:
            raise ValueError("vector dimension must not be negative")
        self.dim = dim
        self.schema = T.StructType(
            [T.StructField(label, T.DoubleType(), False), T.StructField(features, VectorUDT(), False)])

    def decode(self, body: bytes) -> pa.RecordBatch:
        lines = pa.array(body.decode().splitlines(), pa.string())
        labels, features, good = text.libsvm_batch(lines, self.dim)
        if not good.all():
            raise ValueError("malformed line in the response")
        return pa.RecordBatch.from_arrays([labels, features], names=self.schema.fieldNames())
