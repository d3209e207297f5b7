"""Byte layout of records and frames, worked out for a whole Arrow batch at a time."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa

# Framing (fixed values): each frame is magic, body length (both little-endian int32), body,
# then zero bytes up to a multiple of 4.
MAGIC = 0xCED7230A
ALIGNMENT = 4

# Protobuf tags of the record schema (fixed values): field number * 8 + wire type 2 (length-delimited).
RECORD_FEATURES = 0x0A
RECORD_LABEL = 0x12
RECORD_UID = 0x1A
RECORD_METADATA = 0x22
RECORD_CONFIGURATION = 0x2A
ENTRY_KEY = 0x0A
ENTRY_VALUE = 0x12
VALUE_FLOAT32 = 0x12
VALUE_FLOAT64 = 0x1A
VALUE_INT32 = 0x3A
VALUE_BYTES = 0x4A
TENSOR_VALUES = 0x0A
TENSOR_KEYS = 0x12
TENSOR_SHAPE = 0x1A
# Map key of vectors and labels (fixed value).
VALUES_KEY = b"values"


class Ragged:
    """One byte string per row: their bytes end to end, and their lengths."""

    def __init__(self, data: np.ndarray, lengths: np.ndarray):
        self.data = data
        self.lengths = lengths

    @classmethod
    def constant(cls, text: bytes, keep: np.ndarray) -> Ragged:
        """``text`` for the rows in ``keep``, nothing for the others."""
        lengths = np.where(keep, len(text), 0).astype(np.int64)
        return cls(np.tile(np.frombuffer(text, np.uint8), int(keep.sum())), lengths)

    @classmethod
    def varints(cls, numbers: np.ndarray, keep: np.ndarray | None = None) -> Ragged:
        data, sizes = encode_varints(numbers if keep is None else numbers[keep])
        if keep is None:
            return cls(data, sizes)
        lengths = np.zeros(len(numbers), np.int64)
        lengths[keep] = sizes
        return cls(data, lengths)


def varint_sizes(numbers: np.ndarray) -> np.ndarray:
    numbers = numbers.astype(np.uint64)
    sizes = np.ones(len(numbers), np.int64)
    for shift in range(7, 64, 7):
        sizes += numbers >= np.uint64(1 << shift)
    return sizes


def encode_varints(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Base-128 bytes of each number, end to end, and how many bytes each took."""
    numbers = numbers.astype(np.uint64)
    sizes = varint_sizes(numbers)
    widest = int(sizes.max()) if len(sizes) else 0
    place = np.arange(widest)
    groups = (numbers[:, None] >> (7 * place).astype(np.uint64)) & np.uint64(0x7F)
    more = place < (sizes[:, None] - 1)
    return (groups.astype(np.uint8) | (more.astype(np.uint8) << 7))[place < sizes[:, None]], sizes


def decode_varints(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers encoded end to end in ``data``, and the position after each."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    ends = np.flatnonzero(data < 0x80) + 1
    if not len(ends) or ends[-1] != len(data):
        raise ValueError("truncated number")
    begins = np.concatenate(([0], ends[:-1]))
    place = np.arange(len(data)) - np.repeat(begins, ends - begins)
    parts = (data & 0x7F).astype(np.uint64) << (7 * place).astype(np.uint64)
    return np.add.reduceat(parts, begins).astype(np.int64), ends


def join(parts: list[Ragged]) -> Ragged:
    """Concatenate the parts row by row."""
    lengths = sum(part.lengths for part in parts)
    rows = len(lengths)
    if rows and all((part.lengths == part.lengths[0]).all() for part in parts):
        blocks = [part.data.reshape(rows, int(part.lengths[0])) for part in parts]
        return Ragged(np.concatenate(blocks, axis=1).ravel(), lengths)
    out = np.empty(int(lengths.sum()), np.uint8)
    cursor = np.concatenate(([0], np.cumsum(lengths)[:-1])).astype(np.int64)
    for part in parts:
        before = np.concatenate(([0], np.cumsum(part.lengths)[:-1])).astype(np.int64)
        out[np.arange(len(part.data)) + np.repeat(cursor - before, part.lengths)] = part.data
        cursor = cursor + part.lengths
    return Ragged(out, lengths)


def binary_array(rows: Ragged) -> pa.Array:
    total = int(rows.lengths.sum())
    if total >= 1 << 31:
        raise ValueError("batch above 2 GiB; lower spark.sql.execution.arrow.maxRecordsPerBatch")
    offsets = np.concatenate(([0], np.cumsum(rows.lengths))).astype(np.int32)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows.data))]
    return pa.Array.from_buffers(pa.binary(), len(rows.lengths), buffers)


def _wrapped(tag: int, sizes: np.ndarray, keep: np.ndarray) -> list[Ragged]:
    """Tag and length in front of a length-delimited field."""
    return [Ragged.constant(bytes([tag]), keep), Ragged.varints(sizes, keep)]


def _field_sizes(sizes: np.ndarray) -> np.ndarray:
    return 1 + varint_sizes(sizes) + sizes


def encode_records(values: np.ndarray, counts: np.ndarray, keys: np.ndarray, key_counts: np.ndarray,
                   shapes: np.ndarray, shape_counts: np.ndarray, labels: np.ndarray | None = None,
                   has_label: np.ndarray | None = None, uids: Ragged | None = None) -> Ragged:
    """Records of one float32 feature tensor and an optional one-value label per row."""
    rows = len(counts)
    everyone = np.ones(rows, bool)
    narrowed = values.astype("<f4").view(np.uint8)
    value_sizes = counts * 4

    def packed(numbers: np.ndarray, per_row: np.ndarray) -> Ragged:
        data, sizes = encode_varints(numbers)
        ends = np.concatenate(([0], np.cumsum(sizes)))
        bounds = np.concatenate(([0], np.cumsum(per_row))).astype(np.int64)
        return Ragged(data, np.diff(ends[bounds]))

    key_bytes, shape_bytes = packed(keys, key_counts), packed(shapes, shape_counts)
    filled = [counts > 0, key_counts > 0, shape_counts > 0]
    blocks = [Ragged(narrowed, value_sizes), key_bytes, shape_bytes]
    tensor: list[Ragged] = []
    tensor_sizes = np.zeros(rows, np.int64)
    for tag, keep, block in zip((TENSOR_VALUES, TENSOR_KEYS, TENSOR_SHAPE), filled, blocks):
        tensor += [*_wrapped(tag, block.lengths, keep), block]
        tensor_sizes += np.where(keep, _field_sizes(block.lengths), 0)
    value_sizes_all = _field_sizes(tensor_sizes)
    name = bytes([ENTRY_KEY, len(VALUES_KEY)]) + VALUES_KEY
    entry_sizes = len(name) + _field_sizes(value_sizes_all)
    parts = [
        *_wrapped(RECORD_FEATURES, entry_sizes, everyone),
        Ragged.constant(name, everyone),
        *_wrapped(ENTRY_VALUE, value_sizes_all, everyone),
        *_wrapped(VALUE_FLOAT32, tensor_sizes, everyone),
        *tensor,
    ]
    if labels is not None:
        keep = everyone if has_label is None else has_label
        tensor_head = bytes([TENSOR_VALUES, 4])
        value_head = bytes([VALUE_FLOAT32, len(tensor_head) + 4]) + tensor_head
        entry_head = name + bytes([ENTRY_VALUE, len(value_head) + 4]) + value_head
        head = bytes([RECORD_LABEL, len(entry_head) + 4]) + entry_head
        label_bytes = labels[keep].astype("<f4").view(np.uint8)
        parts += [Ragged.constant(head, keep), Ragged(label_bytes, np.where(keep, 4, 0))]
    if uids is not None:
        present = uids.lengths > 0
        parts += [*_wrapped(RECORD_UID, uids.lengths, present), uids]
    return join(parts)


def encode_frames(bodies: Ragged) -> Ragged:
    everyone = np.ones(len(bodies.lengths), bool)
    lengths = Ragged(bodies.lengths.astype("<i4").view(np.uint8), np.full(len(bodies.lengths), 4))
    padding = -bodies.lengths % ALIGNMENT
    pad = Ragged(np.zeros(int(padding.sum()), np.uint8), padding)
    return join([Ragged.constant(struct.pack("<I", MAGIC), everyone), lengths, bodies, pad])


def frame_spans(data: np.ndarray, partial: bool = False) -> tuple[np.ndarray, np.ndarray, int]:
    """Start and length of every body in framed ``data``, and the position after the last frame.

    With ``partial``, an unfinished last frame is left over; otherwise it is an error.
    """
    starts: list[np.ndarray] = []
    lengths: list[np.ndarray] = []
    single_starts: list[int] = []
    single_lengths: list[int] = []

    def flush() -> None:
        if single_starts:
            starts.append(np.array(single_starts, np.int64))
            lengths.append(np.array(single_lengths, np.int64))
            single_starts.clear()
            single_lengths.clear()

    position, end = 0, len(data)
    head = struct.Struct("<Ii").unpack_from
    previous, probe = -1, 1
    while end - position >= 8:
        magic, size = head(data, position)
        if magic != MAGIC:
            raise ValueError("not a frame: wrong magic number")
        if size < 0:
            raise ValueError("not a frame: negative length")
        stride = 8 + size + -size % ALIGNMENT
        if position + stride > end:
            break
        if size != previous:
            single_starts.append(position + 8)
            single_lengths.append(size)
            position += stride
            previous, probe = size, 1
            continue
        # Frames of one length often follow each other. While they do, look ever further ahead.
        probe = min(probe * 4, 1 << 16)
        run = min((end - position) // stride, probe)
        heads = data[position : position + run * stride].reshape(run, stride)[:, :8]
        differing = np.flatnonzero((heads != heads[0]).any(axis=1))
        if len(differing):
            run = int(differing[0])
        flush()
        starts.append(position + 8 + stride * np.arange(run, dtype=np.int64))
        lengths.append(np.full(run, size, np.int64))
        position += run * stride
    flush()
    if not partial and position != end:
        raise ValueError("truncated frame")
    if not starts:
        return np.empty(0, np.int64), np.empty(0, np.int64), position
    return np.concatenate(starts), np.concatenate(lengths), position


def gather(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> Ragged:
    """The given spans of ``data``, end to end."""
    if len(lengths) and (lengths == lengths[0]).all():
        return Ragged(data[starts[:, None] + np.arange(int(lengths[0]))].ravel(), lengths)
    before = np.concatenate(([0], np.cumsum(lengths)[:-1])).astype(np.int64)
    return Ragged(data[np.arange(int(lengths.sum())) + np.repeat(starts - before, lengths)], lengths)


def _varint(data: bytes, position: int) -> tuple[int, int]:
    number = shift = 0
    while True:
        byte = data[position]
        number |= (byte & 0x7F) << shift
        position += 1
        if byte < 0x80:
            return number, position
        shift += 7


def _fields(data: bytes, position: int, end: int):
    """(tag, begin, end) of each field; fixed-width and varint fields give their raw bytes."""
    while position < end:
        tag, position = _varint(data, position)
        wire = tag & 7
        if wire == 2:
            size, begin = _varint(data, position)
            stop = begin + size
        elif wire == 0:
            begin = position
            _, stop = _varint(data, position)
        elif wire in (1, 5):
            begin, stop = position, position + (8 if wire == 1 else 4)
        else:
            raise ValueError("malformed record")
        if stop > end:
            raise ValueError("truncated record")
        yield tag, begin, stop
        position = stop


def tensor_spans(data: bytes, position: int, end: int) -> dict[str, list[tuple[int, int]]]:
    spans: dict[str, list[tuple[int, int]]] = {"values": [], "keys": [], "shape": []}
    for tag, begin, stop in _fields(data, position, end):
        # Unpacked writers repeat the field with another wire type; the number is the same.
        name = {1: "values", 2: "keys", 3: "shape"}.get(tag >> 3)
        if name:
            spans[name].append((begin, stop))
    return spans


def record_entries(data: bytes) -> dict:
    """Named values of a record: ``{"features": [(name, arm, begin, end)], "label": [...], "uid": ...}``."""
    found: dict = {"features": [], "label": [], "uid": None, "metadata": None, "configuration": None}
    text = {RECORD_UID: "uid", RECORD_METADATA: "metadata", RECORD_CONFIGURATION: "configuration"}
    arms = {VALUE_FLOAT32: "float32", VALUE_FLOAT64: "float64", VALUE_INT32: "int32", VALUE_BYTES: "bytes"}
    for tag, begin, stop in _fields(data, 0, len(data)):
        if tag in (RECORD_FEATURES, RECORD_LABEL):
            name, arm, span = "", None, (stop, stop)
            for entry_tag, entry_begin, entry_stop in _fields(data, begin, stop):
                if entry_tag == ENTRY_KEY:
                    name = data[entry_begin:entry_stop].decode()
                elif entry_tag == ENTRY_VALUE:
                    for value_tag, value_begin, value_stop in _fields(data, entry_begin, entry_stop):
                        if value_tag in arms:
                            arm, span = arms[value_tag], (value_begin, value_stop)
            found["features" if tag == RECORD_FEATURES else "label"].append((name, arm, *span))
        elif tag in text:
            found[text[tag]] = (begin, stop)
    return found


class Lists:
    """A list per row, put together from groups of rows."""

    def __init__(self, rows: int, dtype):
        self.counts = np.zeros(rows, np.int64)
        self.dtype = dtype
        self._groups: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def put(self, rows: np.ndarray, counts: np.ndarray, values: np.ndarray) -> None:
        """The lists of ``rows``, end to end in ``values``."""
        self.counts[rows] = counts
        if len(values):
            self._groups.append((rows, counts, values))

    def flat(self) -> np.ndarray:
        if len(self._groups) == 1 and len(self._groups[0][2]) == self.counts.sum() and (np.diff(self._groups[0][0]) > 0).all():
            return self._groups[0][2].astype(self.dtype, copy=False)
        out = np.empty(int(self.counts.sum()), self.dtype)
        begins = np.concatenate(([0], np.cumsum(self.counts)[:-1])).astype(np.int64)
        for rows, counts, values in self._groups:
            before = np.cumsum(counts) - counts
            out[np.arange(len(values)) + np.repeat(begins[rows] - before, counts)] = values
        return out


class TensorBatch:
    """One float32 tensor per row, where there is one."""

    def __init__(self, rows: int):
        self.present = np.zeros(rows, bool)
        self.values, self.keys, self.shapes = Lists(rows, np.float64), Lists(rows, np.int64), Lists(rows, np.int64)

    def put(self, rows: np.ndarray, values: Ragged, keys: Ragged, shape: Ragged) -> None:
        """Tensors of ``rows`` from the bytes of their three fields."""
        if (values.lengths % 4).any():
            raise ValueError("truncated number")
        self.present[rows] = True
        self.values.put(rows, values.lengths // 4, np.ascontiguousarray(values.data).view("<f4").astype(np.float64))
        for lists, packed in ((self.keys, keys), (self.shapes, shape)):
            numbers, ends = decode_varints(packed.data)
            bounds = np.cumsum(packed.lengths)
            # A row must end where a number ends.
            if not np.isin(bounds[packed.lengths > 0], ends).all():
                raise ValueError("truncated number")
            lists.put(rows, np.diff(np.concatenate([[0], np.searchsorted(ends, bounds, "right")])), numbers)


def _find(raw: bytes, wanted: list[tuple[str, str]]) -> tuple[list, dict]:
    """Spans of each wanted tensor in a record (None where the name is missing), and its entries."""
    entries = record_entries(raw)
    found = []
    for side, name in wanted:
        match = next((e for e in entries[side] if e[0] == name), None)
        if match is None:
            found.append(None)
        elif match[1] == "float32":
            found.append(tensor_spans(raw, match[2], match[3]))
        else:
            # Another kind of value reads as an empty float32 tensor.
            found.append({"values": [], "keys": [], "shape": []})
    return found, entries


def _varints_at(data: np.ndarray, at: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A number at every place, the place after it, and whether it is whole."""
    number, shift = np.zeros(len(at), np.int64), 0
    after, open_ = at.copy(), np.ones(len(at), bool)
    while open_.any() and shift < 63:
        open_ &= after < end
        byte = data[np.minimum(after, len(data) - 1)].astype(np.int64)
        number = np.where(open_, number | ((byte & 0x7F) << shift), number)
        ended = open_ & (byte < 0x80)
        after = np.where(open_, after + 1, after)
        open_ &= ~ended
        shift += 7
        if (after >= end)[open_].any() or shift >= 63:
            return number, after, ~open_
    return number, after, ~open_


def _walk(data: np.ndarray, begin: np.ndarray, end: np.ndarray):
    """Fields of many messages at once: (message, tag, begin, end) of each, in order, and which messages are odd.

    Only length-delimited fields are followed; a message with any other, or a broken one, is odd.
    """
    odd = np.zeros(len(begin), bool)
    found: list[tuple[np.ndarray, ...]] = []
    message, at = np.flatnonzero(begin < end), begin[begin < end]
    while len(message):
        tag = data[at].astype(np.int64)
        size, first, whole = _varints_at(data, at + 1, end[message])
        stop = first + size
        good = (tag & 7 == 2) & (tag < 0x80) & whole & (stop <= end[message])
        odd[message[~good]] = True
        message, tag, first, stop = message[good], tag[good], first[good], stop[good]
        found.append((message, tag, first, stop))
        more = stop < end[message]
        message, at = message[more], stop[more]
    if not found:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty, odd
    return (*(np.concatenate(part) for part in zip(*found)), odd)


def _spans_of(message: np.ndarray, chosen: np.ndarray, begin: np.ndarray, end: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """By message, the span of its last chosen field; an empty one without any."""
    first, last = np.zeros(n, np.int64), np.zeros(n, np.int64)
    first[message[chosen]], last[message[chosen]] = begin[chosen], end[chosen]
    return first, last


def decode_tensors(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray,
                   wanted: list[tuple[str, str]], uids: Lists | None = None) -> list[TensorBatch]:
    """Float32 tensors of records, for each wanted (``features`` or ``label``, name).

    Messages are walked level by level, all records at once, whatever their lengths; the fields of a
    tensor are then gathered as bytes. Records of a foreign layout (unpacked or repeated fields) are
    read one by one. The first entry of a name wins. ``uids`` collects the bytes of the records' identifiers.
    """
    rows = len(starts)
    batches = [TensorBatch(rows) for _ in wanted]
    record, tag, begin, end, odd = _walk(data, starts, starts + lengths)
    entry_of, entry_tag, entry_begin, entry_end = (x[np.isin(tag, (RECORD_FEATURES, RECORD_LABEL))] for x in (record, tag, begin, end))
    inner, inner_tag, inner_begin, inner_end, bad = _walk(data, entry_begin, entry_end)
    odd[entry_of[bad]] = True
    key = _spans_of(inner, inner_tag == ENTRY_KEY, inner_begin, inner_end, len(entry_of))
    value_message = inner[inner_tag == ENTRY_VALUE]
    odd[entry_of[value_message[np.bincount(value_message, minlength=len(entry_of))[value_message] > 1]]] = True
    value = _spans_of(inner, inner_tag == ENTRY_VALUE, inner_begin, inner_end, len(entry_of))
    if uids is not None:
        uid = _spans_of(record, tag == RECORD_UID, begin, end, rows)
    followed = []
    for batch, (side, name) in zip(batches, wanted):
        text = np.frombuffer(name.encode(), np.uint8)
        named = (entry_tag == (RECORD_FEATURES if side == "features" else RECORD_LABEL)) & (key[1] - key[0] == len(text))
        at = np.flatnonzero(named)
        if len(text):
            at = at[(data[key[0][at][:, None] + np.arange(len(text))] == text).all(axis=1)]
        at = at[np.argsort(entry_of[at], kind="stable")]
        at = at[np.unique(entry_of[at], return_index=True)[1]]
        arm, arm_tag, arm_begin, arm_end, bad = _walk(data, value[0][at], value[1][at])
        odd[entry_of[at[bad]]] = True
        known = np.isin(arm_tag, (VALUE_FLOAT32, VALUE_FLOAT64, VALUE_INT32, VALUE_BYTES))
        odd[entry_of[at[arm[known][np.bincount(arm[known], minlength=len(at))[arm[known]] > 1]]]] = True
        # Another kind of value reads as an empty float32 tensor.
        tensor = _spans_of(arm, arm_tag == VALUE_FLOAT32, arm_begin, arm_end, len(at))
        part, part_tag, part_begin, part_end, bad = _walk(data, *tensor)
        odd[entry_of[at[bad]]] = True
        again = np.bincount(part * 4 + np.minimum(part_tag >> 3, 3) if len(part) else part, minlength=1)
        odd[entry_of[at[part[again[part * 4 + np.minimum(part_tag >> 3, 3)] > 1]]]] = True
        fields = [_spans_of(part, part_tag == t, part_begin, part_end, len(at)) for t in (TENSOR_VALUES, TENSOR_KEYS, TENSOR_SHAPE)]
        followed.append((batch, entry_of[at], fields))
    for batch, of, fields in followed:
        plain = ~odd[of]
        batch.put(of[plain], *[gather(data, a[plain], (b - a)[plain]) for a, b in fields])
    if uids is not None:
        plain = np.flatnonzero(~odd & (uid[1] > uid[0]))
        spans = gather(data, uid[0][plain], (uid[1] - uid[0])[plain])
        uids.put(plain, spans.lengths, spans.data)
    for row in np.flatnonzero(odd):
        raw = data[starts[row]:starts[row] + lengths[row]].tobytes()
        found, entries = _find(raw, wanted)
        at = np.array([row])
        for batch, spans in zip(batches, found):
            if spans is not None:
                held = [np.frombuffer(b"".join(raw[a:b] for a, b in spans[field]), np.uint8) for field in ("values", "keys", "shape")]
                batch.put(at, *[Ragged(x, np.array([len(x)])) for x in held])
        if uids is not None and entries["uid"]:
            text = np.frombuffer(raw[slice(*entries["uid"])], np.uint8)
            uids.put(at, np.array([len(text)]), text)
    return batches
