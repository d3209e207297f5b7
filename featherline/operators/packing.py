"""Packing encoded rows into bounded payloads, and pairing rows with a scorer's answers."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any, Protocol

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from featherline.functions import vectors
from featherline.operators.ordered import running
from featherline.operators.tables import join_table

MAX_BYTES = 5242880
MAX_RECORDS = 2147483647
#: Parts of a group that look up its number of shards side by side.
SLICES = 256


class Encoder(Protocol):
    """Turns a row into bytes: a schema check and a column expression."""

    content_type: str

    def validate(self, schema: T.StructType) -> None: ...

    def encode(self) -> Column: ...


class Decoder(Protocol):
    """Turns a response body into rows of ``schema``, one Arrow batch per body."""

    schema: T.StructType
    accepts: str

    def decode(self, body: bytes) -> pa.RecordBatch: ...


def require_bounds(max_bytes: int, max_records: int) -> None:
    if max_bytes < 1 or max_records < 1:
        raise ValueError("payload bounds must be at least 1")


class Filler:
    """Greedy payload boundaries over a stream of row sizes; remembers how full the open payload is."""

    def __init__(self, max_bytes: int, max_records: int):
        self.max_bytes, self.max_records = max_bytes, max_records
        self.bytes = self.rows = 0

    def stretches(self, sizes: np.ndarray, fresh: np.ndarray) -> Iterator[tuple[int, int, bool]]:
        """(begin, stop, opens): rows of one payload, and whether they open a new one.

        ``fresh`` flags rows that start a new group. Each stretch is found by a search in the
        cumulative sizes.
        """
        ends = np.concatenate(([0], np.cumsum(sizes)))
        begin = 0
        for border in np.append(np.flatnonzero(fresh), len(sizes)).tolist():
            while begin < border:
                if fresh[begin]:
                    self.bytes = self.rows = 0
                fit = int(np.searchsorted(ends, ends[begin] + self.max_bytes - self.bytes, side="right")) - 1
                stop = min(fit, begin + self.max_records - self.rows, border)
                if stop <= begin:
                    self.bytes = self.rows = 0
                    continue
                opens = self.rows == 0
                self.bytes += int(ends[stop] - ends[begin])
                self.rows += stop - begin
                yield begin, stop, opens
                begin = stop


def _binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_binary())
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.empty(0, np.uint8), offsets


def _new_groups(batch: pa.RecordBatch, names: Sequence[str], previous: tuple | None) -> np.ndarray:
    """Which rows differ from the row before in any of the named columns."""
    changed = np.zeros(batch.num_rows, bool)
    for position, name in enumerate(names):
        codes = batch.column(batch.schema.get_field_index(name)).dictionary_encode(null_encoding="encode")
        numbers = codes.indices.to_numpy(zero_copy_only=False)
        changed[1:] |= numbers[1:] != numbers[:-1]
        if previous is not None and codes.slice(0, 1).to_pylist()[0] != previous[position]:
            changed[0] = True
    return changed


def _check_size(sizes: np.ndarray, max_bytes: int) -> None:
    if len(sizes) and int(sizes.max()) > max_bytes:
        raise ValueError(f"a row of {int(sizes.max())} bytes is above the payload bound of {max_bytes}")


def _payload_batches(batches: Iterator[pa.RecordBatch], body: str, group: Sequence[str], schema: pa.Schema,
                     max_bytes: int, max_records: int) -> Iterator[pa.RecordBatch]:
    """Stream sorted rows into payload rows. Only the payload being filled is held."""
    filler = Filler(max_bytes, max_records)
    held: list[bytes] = []
    held_bytes = held_rows = number = 0
    current: tuple | None = None
    out: list[dict[str, Any]] = []

    def close() -> None:
        nonlocal held, held_bytes, held_rows, number
        row = dict(zip(group, current or ()))
        row.update(batch_id=number, n_rows=held_rows, n_bytes=held_bytes, payload=b"".join(held))
        out.append(row)
        held, held_bytes, held_rows = [], 0, 0
        number += 1

    for batch in batches:
        if not batch.num_rows:
            continue
        data, offsets = _binary(batch.column(batch.schema.get_field_index(body)))
        sizes = np.diff(offsets)
        _check_size(sizes, max_bytes)
        fresh = _new_groups(batch, group, current)
        keys = [batch.column(batch.schema.get_field_index(name)) for name in group]
        for begin, stop, opens in filler.stretches(sizes, fresh):
            if opens and held_rows:
                close()
            if fresh[begin]:
                number = 0
            current = tuple(k[begin].as_py() for k in keys)
            held.append(data[offsets[begin] : offsets[stop]].tobytes())
            held_bytes += int(offsets[stop] - offsets[begin])
            held_rows += stop - begin
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
            out = []
    if held_rows:
        close()
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def _payload_schema(df: DataFrame, group: Sequence[str]) -> T.StructType:
    schema = T.StructType([df.schema[name] for name in group])
    return (schema.add("batch_id", T.LongType()).add("n_rows", T.LongType())
            .add("n_bytes", T.LongType()).add("payload", T.BinaryType()))


def pack_partitions(df: DataFrame, body: str = "body", max_bytes: int = MAX_BYTES,
                    max_records: int = MAX_RECORDS) -> DataFrame:
    """Fill payloads with each partition's rows as they come; nothing is shuffled.

    ``batch_id`` counts payloads within a partition, which the ``part`` column names.
    """
    require_bounds(max_bytes, max_records)
    numbered = df.select(F.spark_partition_id().alias("part"), F.col(body).cast("binary").alias(body))
    return _pack(numbered, body, ["part"], max_bytes, max_records)


def with_shards(df: DataFrame, group: Sequence[str], key: str, shard_rows: int, name: str = "shard_of") -> DataFrame:
    """Number the rows of each group into as many shards as its size asks for, by an integer key modulo their number.

    Where both sides shuffle, a group's rows meet its number in ``SLICES`` slices by a hash of the key, so that no task reads a whole group.
    """
    sizes = df.groupBy(*group).agg(F.ceil(F.count(F.lit(1)) / shard_rows).alias("_shards"))
    sizes = sizes.withColumn("_slice", F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1))))
    sliced = df.withColumn("_slice", F.pmod(F.xxhash64(key), F.lit(SLICES)).cast("int"))
    return join_table(sliced, sizes, [*group, "_slice"]).withColumn(name, F.pmod(F.col(key), F.col("_shards"))).select(*df.columns, name)


def pack_groups(df: DataFrame, group: Sequence[str], order: Sequence[str], body: str = "body",
                max_bytes: int = MAX_BYTES, max_records: int = MAX_RECORDS,
                shards: Column | None = None, shard_rows: int | None = None) -> DataFrame:
    """Fill payloads within groups, in the given order.

    A payload is filled row after row, so one group and shard is one task's stream; rows stream
    through in sorted order and only the open payload is in memory. Large groups are split, and the
    result then has a ``shard`` column: by ``shards``, any expression over a row such as a hash of its key,
    in one shuffle; or into stretches of ``shard_rows`` rows that follow the order, which numbers the
    rows first. For that, the order should tell rows apart.
    """
    require_bounds(max_bytes, max_records)
    if shard_rows is not None:
        if shards is not None or shard_rows < 1:
            raise ValueError("either shards or a positive shard_rows")
        df = running(df.select(*group, *order, body), group, [F.col(c) for c in order], {"_row": F.lit(1)})
        shards = F.floor((F.col("_row") - 1) / shard_rows)
    names = [*group, "shard"] if shards is not None else list(group)
    columns = [F.col(c) for c in group] + ([shards.alias("shard")] if shards is not None else [])
    extra = [F.col(c).alias(f"_order_{i}") for i, c in enumerate(order)]
    keyed = df.select(*columns, *extra, F.col(body).cast("binary").alias(body))
    ordered = keyed.repartition(*names).sortWithinPartitions(*names, *[f"_order_{i}" for i in range(len(order))])
    return _pack(ordered.select(*names, body), body, names, max_bytes, max_records)


def _pack(df: DataFrame, body: str, group: list[str], max_bytes: int, max_records: int) -> DataFrame:
    schema = _payload_schema(df, group)
    arrow = to_arrow_schema(schema)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _payload_batches(batches, body, group, arrow, max_bytes, max_records)

    return df.mapInArrow(pack, schema)


def score_payloads(df: DataFrame, encoder: Encoder, decoder: Decoder, score: Callable[[bytes], bytes],
                   max_bytes: int = MAX_BYTES, max_records: int = MAX_RECORDS, keep_input: bool = True) -> DataFrame:
    """Encode, pack, score and decode, pairing every input row with its answer by position.

    Rows never leave their partition. A scorer that answers with another number of rows fails.
    """
    require_bounds(max_bytes, max_records)
    encoder.validate(df.schema)
    taken = [f.name for f in decoder.schema if keep_input and f.name in df.columns]
    if taken:
        raise ValueError(f"prediction columns already in the input: {taken}")
    kept = df.columns if keep_input else []
    # Vectors travel to the tasks and back in their lean form.
    lean = {c for c in kept if isinstance(df.schema[c].dataType, VectorUDT)}
    passed = [vectors.lean(F.col(c)).alias(c) if c in lean else F.col(c) for c in kept]
    encoded = df.select(*passed, encoder.encode().cast("binary").alias("_body"))
    result = T.StructType([*[df.schema[c] for c in kept], *decoder.schema])
    decode = decoder.decode
    arrow = to_arrow_schema(result)
    answer_fields = [f.name for f in decoder.schema]

    def answered(rows: pa.RecordBatch, payload: bytes) -> pa.RecordBatch:
        answer = decode(score(payload))
        if answer.num_rows != rows.num_rows:
            raise ValueError(f"{rows.num_rows} rows were sent but {answer.num_rows} came back")
        answers = [answer.column(answer.schema.get_field_index(n)) for n in answer_fields]
        inputs = [vectors.full(rows.column(i)) if c in lean else rows.column(i) for i, c in enumerate(kept)]
        columns = inputs + answers
        return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filler = Filler(max_bytes, max_records)
        pending: list[pa.RecordBatch] = []
        held: list[bytes] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            data, offsets = _binary(batch.column(batch.num_columns - 1))
            sizes = np.diff(offsets)
            _check_size(sizes, max_bytes)
            for begin, stop, opens in filler.stretches(sizes, np.zeros(len(sizes), bool)):
                if opens and pending:
                    yield answered(_concatenated(pending), b"".join(held))
                    pending, held = [], []
                pending.append(batch.slice(begin, stop - begin))
                held.append(data[offsets[begin] : offsets[stop]].tobytes())
        if pending:
            yield answered(_concatenated(pending), b"".join(held))

    return encoded.mapInArrow(run, result)


def _concatenated(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return batches[0] if len(batches) == 1 else pa.concat_batches(batches)

