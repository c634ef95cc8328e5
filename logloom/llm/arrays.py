"""Whole texts as numpy arrays: Arrow's UTF-8 buffers without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text taken into one numpy pass; a longer text is taken whole.
BLOCK_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

# Odd bases of the polynomials. They are arbitrary, but have to stay the same in all tasks.
_BYTE_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xD6E8FEB86659FD93
_SECOND_BASE = 0xA0761D6478BD642F
_POWERS: dict[tuple[int, bool], np.ndarray] = {}
_BYTE_VALUES = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, 256, dtype=np.uint64)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column; NULL is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(len(column) + 1, np.int64), np.zeros(0, np.uint8)
    at = np.frombuffer(offsets, kind)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return at - at[0], held[at[0]: at[-1]]


def blocks(batches, column: str, max_bytes: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows in pieces of about `max_bytes` of text: the rows, the offsets and the bytes of their texts."""
    for batch in batches:
        offsets, data = utf8(batch.column(column))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + max_bytes, side="right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield (batch.slice(first, last - first), offsets[first: last + 1] - offsets[first],
                   data[offsets[first]: offsets[last]])
            first = last


def word_bounds(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word `[^\\x20\\x09-\\x0D]+`, and the first word of every text (one more at
    the end)."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = ~_SPACE[data]
    begins = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begins[edges] = inside[1:-1][edges]
    ends[edges - 1] = inside[1:-1][edges - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def _powers(base: int, n: int, inverse: bool = False) -> np.ndarray:
    held = _POWERS.get((base, inverse))
    if held is None or len(held) < n:
        step = pow(base, -1, 1 << 64) if inverse else base
        held = np.full(max(n, BLOCK_BYTES + 1), step, dtype=np.uint64)
        held[0] = 1
        held = np.cumprod(held)
        _POWERS[base, inverse] = held
    return held[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xE9846AF9B1A615D)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xE9846AF9B1A615D)
    return h ^ (h >> np.uint64(28))


class Prefixes:
    """Prefix polynomial hashes modulo 2^64: the hash of any stretch from two of them."""

    def __init__(self, values: np.ndarray, base: int = _BYTE_BASE):
        n = len(values)
        self.inverse = _powers(base, n + 1, inverse=True)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values * _powers(base, n), out=self.sums[1:])

    def of(self, starts, ends) -> np.ndarray:
        """Raw hash of the stretches [start, end); equal stretches have equal hashes."""
        return (self.sums[ends] - self.sums[starts]) * self.inverse[starts]

    def windows(self, width: int) -> np.ndarray:
        """Mixed hash of the window at every position that has one."""
        n = len(self.sums) - width
        if n <= 0:
            return np.zeros(0, dtype=np.uint64)
        return mix((self.sums[width:] - self.sums[:n]) * self.inverse[:n])


def byte_prefixes(data: np.ndarray) -> Prefixes:
    return Prefixes(_BYTE_VALUES[data])


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every word."""
    return mix(byte_prefixes(data).of(starts, ends) + (ends - starts).astype(np.uint64))


def word_prefixes(words: np.ndarray, second: bool = False) -> Prefixes:
    return Prefixes(words, _SECOND_BASE if second else _WORD_BASE)


def inside_texts(firsts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of the `n` windows of `width` items lie within one text, by the texts' first items."""
    whole = np.ones(max(n, 0), dtype=bool)
    for edge in firsts[1:-1]:
        whole[max(edge - width + 1, 0): edge] = False
    return whole


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Items that lie in a window of `width` from one of `starts`."""
    change = np.zeros(n + 1, dtype=np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + width, n), -1)
    return np.cumsum(change[:-1]) > 0


# Sorted hashes on the wire: differences, byte plane by byte plane, so that Spark's compression drops
# the planes that are zero.


def to_planes(values: np.ndarray) -> bytes:
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes() if len(values) else b""


def from_planes(data: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(dtype).ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending unsigned integers."""
    return to_planes(np.diff(values, prepend=values.dtype.type(0)))


def unpack_sorted(data: bytes, dtype) -> np.ndarray:
    return np.cumsum(from_planes(data, dtype), dtype=dtype) if data else np.zeros(0, dtype)


def pack_bits(bits: np.ndarray) -> bytes:
    return np.packbits(bits).tobytes()


def unpack_bits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)
