"""Words and byte ranges of many texts at once, as numpy arrays over one buffer.

Every separator that the operators use is an ASCII byte, so words of UTF-8 text are runs of bytes. A text
that is null counts as empty. Hashes of byte ranges come from one cumulative sum per buffer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at a time; a longer text is one piece.
PIECE = 1 << 20

SPACE_SEPARATED = np.ones(256, bool)
SPACE_SEPARATED[[0x20, *range(0x09, 0x0E)]] = False
#: [^\x00-\x2F\x3A-\x60\x7B-\x7F]: digits, a-z and every byte of a longer character.
PLAIN_WORDS = np.zeros(256, bool)
PLAIN_WORDS[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit integers over all their bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd base and of its inverse, modulo 2**64, as long as they have been needed."""

    def __init__(self, seed: int):
        random = np.random.default_rng(seed)
        self.base = np.uint64(int(random.integers(1 << 56, 1 << 60)) * 8 + 5)
        self.values = random.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
        inverse = pow(int(self.base), -1, 1 << 64)
        self.inverse = np.uint64(inverse)
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        while len(self.up) <= n:
            grown = len(self.up)
            up = np.uint64(pow(int(self.base), grown, 1 << 64))
            down = np.uint64(pow(int(self.inverse), grown, 1 << 64))
            self.up = np.concatenate([self.up, self.up * up])
            self.down = np.concatenate([self.down, self.down * down])


_POWERS: dict[int, Powers] = {}


def powers(seed: int, n: int) -> Powers:
    if seed not in _POWERS:
        _POWERS[seed] = Powers(seed)
    _POWERS[seed].reach(n)
    return _POWERS[seed]


def row_hashes(rows: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Hash of the k bytes at every place of every row of a matrix of bytes."""
    held, width = powers(seed, rows.shape[1]), rows.shape[1]
    sums = np.zeros((len(rows), width + 1), np.uint64)
    np.cumsum(held.values[rows] * held.up[:width], axis=1, out=sums[:, 1:])
    return mix((sums[:, k:] - sums[:, :-k]) * held.down[: width + 1 - k])


class Hashes:
    """Hashes of any byte range of ``data``; equal ranges have equal hashes in every buffer and process."""

    def __init__(self, data: np.ndarray, seed: int = 1):
        self.powers = powers(seed, len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.powers.values[data] * self.powers.up[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        found = (self.sums[end] - self.sums[start]) * self.powers.down[start]
        return mix(found + (end - start).astype(np.uint64) * _GOLDEN)

    def of_length(self, k: int) -> np.ndarray:
        """Hash of the k bytes at every position."""
        n = len(self.sums) - k
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.sums[k:] - self.sums[:-k]) * self.powers.down[:n])


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column, and where each row begins and ends in them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.dtype(np.int64 if wide else np.int32)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, held = column.buffers()
    offsets = np.frombuffer(places, kind, len(column) + 1, column.offset * kind.itemsize).astype(np.int64)
    data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces(table: pa.RecordBatch | pa.Table, column: str, limit: int = PIECE) -> Iterator[pa.RecordBatch | pa.Table]:
    """Consecutive rows whose texts come to about ``limit`` bytes, at least one row at a time."""
    _, offsets = text_buffer(table.column(column))
    first, rows = 0, table.num_rows
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield table.slice(first, last - first)
        first = last


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every run of bytes of the class ``inside``; runs do not cross rows."""
    n = len(data)
    if not n:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    held = inside[data]
    begins = held.copy()
    begins[1:] &= ~held[:-1]
    ends = held.copy()
    ends[:-1] &= ~held[1:]
    filled = offsets[1:] > offsets[:-1]
    first, last = offsets[:-1][filled], offsets[1:][filled] - 1
    begins[first] = held[first]
    ends[last] = held[last]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def per_row(rows: np.ndarray, n: int) -> np.ndarray:
    """How often each of the rows 0..n-1 occurs."""
    return np.bincount(rows, minlength=n).astype(np.int64)


def shingles(hashes: np.ndarray, rows: np.ndarray, n: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each run of ``size`` words; a row with fewer words (one at least) is one run.

    ``rows`` must be sorted, ``hashes`` are those of the words.
    """
    counts = per_row(rows, n)
    total = len(hashes)
    if not total:
        return hashes, rows
    joined = np.zeros(max(total - size + 1, 0), np.uint64)
    for k in range(size):
        joined = mix(joined * np.uint64(0x100000001B3) + hashes[k:k + len(joined)] + np.uint64(k + 1))
    whole = rows[: len(joined)] == rows[size - 1:] if len(joined) else np.zeros(0, bool)
    found, at = joined[whole], rows[: len(joined)][whole]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        begin = np.searchsorted(rows, short)
        alone = np.zeros(len(short), np.uint64)
        for k in range(size):
            has = counts[short] > k
            alone[has] = mix(alone[has] * np.uint64(0x100000001B3) + hashes[begin[has] + k] + np.uint64(k + 1))
        alone = mix(alone + counts[short].astype(np.uint64))
        found, at = np.concatenate([found, alone]), np.concatenate([at, short])
        order = np.argsort(at, kind="stable")
        found, at = found[order], at[order]
    return found, at
