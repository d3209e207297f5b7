"""``format("recordio")``: framed records as a batch source, a batch sink and a streaming sink.

Options: ``labelColumnName`` and ``featuresColumnName`` (defaults ``label`` and ``features``),
``uidColumnName``, ``compression`` (``gzip``), ``maxFileBytes`` (a task starts a new file beyond it), ``layout`` (reading:
``vectors`` or ``records``), ``rangeBytes`` (reading: files beyond it are read in ranges of it, side by side; 0 for whole files).

A range owns the frames that begin in it. Its first one is where a magic number stands at a multiple of four, with a length that
leads to another frame, ``CHAIN`` times, or to the end of the file; so magic numbers inside bodies mislead nobody. Only a body that itself holds whole
frames right up to its end could, and needs ``rangeBytes`` 0. Compressed files are read whole.
"""

from __future__ import annotations

import gzip
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import SparkSession, types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamArrowWriter,
    InputPartition,
    WriterCommitMessage,
)

from featherline.functions import records, wire
from featherline.sources import files

SUFFIX = ".pbr"
FILE_BYTES = 256 << 20
READ_BYTES = 8 << 20
# Frames that are decoded at a time.
FRAMES = 16384
# Small files are read together up to this size.
PARTITION_BYTES = 8 << 20
STAGING = "_staging"
# A larger file is read in ranges of this size; frames that a range's first one must lead to.
RANGE_BYTES, CHAIN = 32 << 20, 3


@dataclass
class Columns:
    label: str | None
    features: str
    uid: str | None

    @classmethod
    def of(cls, options, schema: T.StructType) -> Columns:
        """Column names to write. Only a label named by an option has to exist."""
        names = schema.fieldNames()
        features = options.get("featuresColumnName", "features")
        if features not in names:
            raise ValueError(f"a vector column named {features} is needed to write records")
        if not records.is_features_type(schema[features].dataType):
            raise ValueError(f"column {features} must hold vectors or matrices")
        label = options.get("labelColumnName")
        if label is not None and label not in names:
            raise ValueError(f"no label column named {label}")
        if label is None:
            label = "label" if "label" in names else None
        if label is not None and not isinstance(schema[label].dataType, T.NumericType):
            raise ValueError(f"label column {label} must be numeric")
        uid = options.get("uidColumnName")
        if uid is not None and uid not in names:
            raise ValueError(f"no uid column named {uid}")
        return cls(label, features, uid)


@dataclass
class Written(WriterCommitMessage):
    files: list[str] = field(default_factory=list)
    rows: int = 0


class _Files:
    """What batch and streaming writers share: staged files per task, moved when the job commits."""

    def __init__(self, options, schema: T.StructType):
        self.path = options["path"]
        self.columns = Columns.of(options, schema)
        self.limit = int(options.get("maxFileBytes", FILE_BYTES))
        compression = options.get("compression", "none").lower()
        if compression not in ("none", "uncompressed", "gzip"):
            raise ValueError(f"unknown compression {compression}")
        self.suffix = SUFFIX + (".gz" if compression == "gzip" else "")
        self.job = uuid.uuid4().hex

    def _frames(self, batch: pa.RecordBatch) -> bytes:
        columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        chosen = self.columns
        bodies = records.encode_batch(
            columns[chosen.features],
            columns[chosen.label] if chosen.label else None,
            columns[chosen.uid] if chosen.uid else None,
        )
        return wire.encode_frames(bodies).data if len(bodies.lengths) else b""

    def _stage(self, batches: Iterator[pa.RecordBatch]) -> Written:
        store, root = files.open_store(self.path)
        context = TaskContext.get()
        part, attempt = context.partitionId(), context.taskAttemptId()
        folder = f"{root}/{STAGING}/{self.job}"
        store.create_dir(folder, recursive=True)
        message = Written()
        stream, size = None, 0
        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                frames = self._frames(batch)
                if stream is not None and size + len(frames) > self.limit:
                    stream.close()
                    stream = None
                if stream is None:
                    name = f"part-{part:05d}-{attempt}-{len(message.files):04d}{self.suffix}"
                    message.files.append(f"{folder}/{name}")
                    raw = store.open_output_stream(message.files[-1], compression=None)
                    stream = _Zipped(raw) if self.suffix.endswith(".gz") else raw
                    size = 0
                stream.write(frames)
                size += len(frames)
                message.rows += batch.num_rows
        finally:
            if stream is not None:
                stream.close()
        return message

    def _publish(self, messages, prefix: str) -> None:
        store, root = files.open_store(self.path)
        store.create_dir(root, recursive=True)
        staged = [f for m in messages if m is not None for f in m.files]
        with ThreadPoolExecutor(32) as pool:
            list(pool.map(lambda f: store.move(f, f"{root}/{prefix}{f.rsplit('/', 1)[1]}"), staged))
        self._discard()

    def _discard(self) -> None:
        store, root = files.open_store(self.path)
        staging = f"{root}/{STAGING}"
        if store.get_file_info(f"{staging}/{self.job}").type == fs.FileType.Directory:
            store.delete_dir(f"{staging}/{self.job}")
        if store.get_file_info(staging).type == fs.FileType.Directory:
            if not store.get_file_info(fs.FileSelector(staging)):
                store.delete_dir(staging)


class _Zipped:
    def __init__(self, raw):
        self.raw = raw
        self.zipped = gzip.GzipFile(fileobj=raw, mode="wb", compresslevel=6, mtime=0)

    def write(self, data) -> None:
        self.zipped.write(data)

    def close(self) -> None:
        self.zipped.close()
        self.raw.close()


class RecordWriter(_Files, DataSourceArrowWriter):
    def __init__(self, options, schema: T.StructType, overwrite: bool):
        super().__init__(options, schema)
        self.overwrite = overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return self._stage(iterator)

    def commit(self, messages) -> None:
        # New files have names of their own and are in place before the old ones go.
        store, root = files.open_store(self.path)
        there = self.overwrite and store.get_file_info(root).type == fs.FileType.Directory
        old = [path for path, _ in files.data_files(self.path)] if there else []
        self._publish(messages, f"{self.job[:8]}-")
        for path in old:
            store.delete_file(path)

    def abort(self, messages) -> None:
        self._discard()


class RecordStreamWriter(_Files, DataSourceStreamArrowWriter):
    """Each batch has its own folder; a replayed batch replaces what it wrote before."""

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return self._stage(iterator)

    def commit(self, messages, batchId: int) -> None:
        store, root = files.open_store(self.path)
        folder = f"{root}/batch-{batchId:010d}"
        store.create_dir(folder, recursive=True)
        old = [info.path for info in store.get_file_info(fs.FileSelector(folder))]
        self._publish(messages, f"batch-{batchId:010d}/{self.job[:8]}-")
        for path in old:
            store.delete_file(path)

    def abort(self, messages, batchId: int) -> None:
        self._discard()


@dataclass
class FileGroup(InputPartition):
    paths: list[str]

    def __init__(self, paths: list[str]):
        super().__init__(None)
        self.paths = paths


@dataclass
class FileRange(InputPartition):
    path: str
    begin: int
    end: int

    def __init__(self, path: str, begin: int, end: int):
        super().__init__(None)
        self.path, self.begin, self.end = path, begin, end


def first_frame(stream: fs.NativeFile, begin: int, end: int, size: int, chunk: int) -> int | None:
    """The first place in [begin, end) of a file of ``size`` bytes where a frame begins; both are multiples of four."""

    def leads_on(at: int) -> bool:
        for _ in range(CHAIN):
            if at == size:
                return True
            if at + 8 > size:
                return False
            magic, length = np.frombuffer(stream.read_at(8, at), "<u4").tolist()
            if magic != wire.MAGIC or length >= 1 << 31:
                return False
            at += 8 + length + -length % wire.ALIGNMENT
        return at <= size

    for start in range(begin, end, chunk):
        data = stream.read_at(min(chunk, size - start), start)
        words = np.frombuffer(data, "<u4", len(data) // 4)
        for at in (start + 4 * np.flatnonzero(words == wire.MAGIC)).tolist():
            if at < end and leads_on(at):
                return at
    return None


class RecordReader(DataSourceReader):
    def __init__(self, options, schema: T.StructType):
        self.path = options["path"]
        self.schema = schema
        self.layout = options.get("layout", "vectors")
        self.features = options.get("featuresColumnName", "features")
        self.label = options.get("labelColumnName", "label")
        self.uid = options.get("uidColumnName")
        self.chunk = max(8, int(options.get("readBytes", READ_BYTES)) // 4 * 4)
        self.range = int(options.get("rangeBytes", RANGE_BYTES)) // 4 * 4

    def partitions(self) -> list[InputPartition]:
        groups: list[list[str]] = []
        room = 0
        ranges = []
        for path, size in files.data_files(self.path):
            if 0 < self.range < size and not path.endswith(".gz"):
                ranges += [FileRange(path, begin, min(begin + self.range, size)) for begin in range(0, size, self.range)]
                continue
            if not groups or size > room:
                groups.append([])
                room = PARTITION_BYTES
            groups[-1].append(path)
            room -= size
        return [*[FileGroup(g) for g in groups], *ranges] or [FileGroup([])]

    def _read_range(self, store: fs.FileSystem, part: FileRange) -> Iterator[pa.RecordBatch]:
        with store.open_input_file(part.path) as stream:
            size = stream.size()
            position = first_frame(stream, part.begin, part.end, size, self.chunk) if part.begin else 0
            if position is None:
                return
            at, rest = position, b""  # what comes next, and the bytes before it from ``position`` on
            while position < part.end:
                piece = stream.read_at(min(self.chunk, size - at), at) if at < size else b""
                if not piece:
                    raise ValueError(f"truncated frame at the end of {part.path}")
                at += len(piece)
                data = np.frombuffer(rest + piece, np.uint8)
                starts, lengths, stop = wire.frame_spans(data, partial=True)
                own = position + starts - 8 < part.end
                yield from self._batches(data, starts[own], lengths[own])
                if not own.all():
                    return
                rest, position = data[stop:].tobytes(), position + stop

    def read(self, partition: FileGroup | FileRange) -> Iterator[pa.RecordBatch]:
        store, _ = files.open_store(self.path)
        if isinstance(partition, FileRange):
            yield from self._read_range(store, partition)
            return
        for path in partition.paths:
            rest = b""
            for piece in files.chunks(store, path, self.chunk):
                data = np.frombuffer(rest + piece, np.uint8)
                starts, lengths, end = wire.frame_spans(data, partial=True)
                rest = data[end:].tobytes()
                yield from self._batches(data, starts, lengths)
            if rest:
                raise ValueError(f"truncated frame at the end of {path}")

    def _batches(self, data, starts, lengths) -> Iterator[pa.RecordBatch]:
        """Frames of a chunk, a bounded number at a time: a chunk of small ones decodes into many times its bytes."""
        for first in range(0, len(starts), FRAMES):
            yield self._batch(data, starts[first:first + FRAMES], lengths[first:first + FRAMES])

    def _batch(self, data, starts, lengths) -> pa.RecordBatch:
        if self.layout == "records":
            rows = [records.parse_body(data[s : s + n].tobytes()) for s, n in zip(starts, lengths)]
            return pa.RecordBatch.from_struct_array(pa.array(rows, records.record_arrow_type()))
        uids = wire.Lists(len(starts), np.uint8)
        features, label = wire.decode_tensors(
            data, starts, lengths, [("features", "values"), ("label", "values")], uids if self.uid else None)
        if (features.shapes.counts > 1).any():
            raise ValueError("the file holds matrices, whose shape a vector cannot keep: read it with layout records")
        columns = {self.features: lambda: records.vector_column(features), self.label: lambda: _labels(label)}
        if self.uid:
            columns[self.uid] = lambda: _texts(uids)
        return pa.RecordBatch.from_arrays([columns[n]() for n in self.schema.fieldNames()], names=self.schema.fieldNames())


def _labels(batch: wire.TensorBatch) -> pa.Array:
    if (batch.values.counts[batch.present] != 1).any():
        raise ValueError("a label must hold one value")
    numbers = np.zeros(len(batch.present))
    numbers[batch.present] = batch.values.flat()
    return pa.array(numbers, mask=~batch.present)


def _texts(lists: wire.Lists) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(lists.counts))).astype(np.int32)
    texts = pa.Array.from_buffers(pa.string(), len(lists.counts), [None, pa.py_buffer(offsets), pa.py_buffer(lists.flat())])
    return pc.if_else(pa.array(lists.counts > 0), texts, pa.scalar(None, pa.string()))


class RecordSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "recordio"

    def schema(self) -> T.StructType:
        if self.options.get("layout", "vectors") == "records":
            return records.RECORD
        schema = T.StructType()
        if self.options.get("uidColumnName"):
            schema.add(self.options["uidColumnName"], T.StringType())
        schema.add(self.options.get("labelColumnName", "label"), T.DoubleType())
        return schema.add(self.options.get("featuresColumnName", "features"), VectorUDT())

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return RecordReader(self.options, schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        return RecordWriter(self.options, schema, overwrite)

    def streamWriter(self, schema: T.StructType, overwrite: bool) -> DataSourceStreamArrowWriter:
        return RecordStreamWriter(self.options, schema)


def register(spark: SparkSession) -> None:
    """Make ``format("recordio")`` known to the session."""
    spark.dataSource.register(RecordSource)
