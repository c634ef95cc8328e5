"""A range asymmetric numeral system with static tables and interleaved lanes, in numpy.

A block holds `n` ids in `LANES` independent coders: id i belongs to lane i mod `LANES`, so a step of
the coder works on one row of ids at once. A coder's state stays in [2^31, 2^63); 32 bits at a time go
to or come from the words of the block, those of a step in the order of the lanes.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np

LANES = 4096
BLOCK_IDS = 1 << 20
#: Bits of the sum of all frequencies in a table.
TABLE_BITS = 18

_LOW = np.uint64(1 << 31)
_BITS = np.uint64(TABLE_BITS)
_WORD = np.uint64(32)
_MASK = np.uint64((1 << TABLE_BITS) - 1)


@dataclass(frozen=True)
class Table:
    """Symbols that occur, ascending, and their frequencies, which add up to 2^TABLE_BITS."""

    symbols: np.ndarray
    frequencies: np.ndarray

    @classmethod
    def of(cls, ids: np.ndarray) -> Table:
        counts = np.bincount(ids)
        symbols = np.flatnonzero(counts)
        return cls(symbols.astype(np.uint32), _scaled(counts[symbols]).astype(np.uint32))

    def starts(self) -> np.ndarray:
        return (np.cumsum(self.frequencies, dtype=np.uint64) - self.frequencies).astype(np.uint64)


def _scaled(counts: np.ndarray) -> np.ndarray:
    """Frequencies of at least 1 that add up to 2^TABLE_BITS, near the shares of the counts."""
    total = 1 << TABLE_BITS
    if len(counts) > total:
        raise ValueError("more symbols than the table has places for")
    scaled = np.maximum(1, counts * total // max(int(counts.sum()), 1))
    order = np.argsort(-scaled, kind="stable")
    left = total - int(scaled.sum())
    if left >= 0 and len(order):
        scaled[order[0]] += left
    while left < 0:
        take = np.minimum(scaled[order] - 1, np.maximum(1, scaled[order] * -left // total))
        take = np.diff(np.minimum(np.cumsum(take), -left), prepend=0)
        scaled[order] -= take
        left += int(take.sum())
    return scaled


def encode_block(ids: np.ndarray, table: Table) -> tuple[np.ndarray, np.ndarray]:
    """Final states of the lanes and the words of a block."""
    at = np.zeros(int(table.symbols[-1]) + 1, dtype=np.int64) if len(ids) else np.zeros(0, np.int64)
    at[table.symbols] = np.arange(len(table.symbols))
    place = at[ids]
    f = table.frequencies.astype(np.uint64)[place]
    c = table.starts()[place]
    limit = f << np.uint64(63 - TABLE_BITS)
    x = np.full(LANES, _LOW, dtype=np.uint64)
    written = []
    for first in reversed(range(0, len(ids), LANES)):
        row = slice(first, min(first + LANES, len(ids)))
        state, fr = x[: row.stop - first], f[row]
        over = state >= limit[row]
        full = state[over]
        written.append(full.astype(np.uint32))
        state[over] = full >> _WORD
        quotient = state // fr
        state[:] = (quotient << _BITS) + (state - quotient * fr) + c[row]
    return x, np.concatenate(written[::-1]) if written else np.zeros(0, np.uint32)


def decode_block(n: int, states: np.ndarray, words: np.ndarray, table: Table,
                 slots: np.ndarray | None = None) -> np.ndarray:
    """The ids of a block, which needs nothing of its neighbours."""
    if slots is None:
        slots = slot_table(table)
    f, c = table.frequencies.astype(np.uint64), table.starts()
    x = states.astype(np.uint64)
    out = np.empty(n, dtype=np.int64)
    at = 0
    for first in range(0, n, LANES):
        last = min(first + LANES, n)
        state = x[: last - first]
        slot = state & _MASK
        symbol = slots[slot]
        out[first:last] = symbol
        state[:] = f[symbol] * (state >> _BITS) + slot - c[symbol]
        under = np.flatnonzero(state < _LOW)
        if at + len(under) > len(words):
            raise ValueError("damaged block: words are missing")
        state[under] = (state[under] << _WORD) | words[at: at + len(under)]
        at += len(under)
    if at != len(words) or (x != _LOW).any():
        raise ValueError("damaged block: the coder did not return to its first state")
    return table.symbols[out]


def slot_table(table: Table) -> np.ndarray:
    """Index of the symbol of every slot."""
    return np.repeat(np.arange(len(table.symbols)), table.frequencies)


def checksum(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4"))


def checksums(ids: np.ndarray, firsts: np.ndarray) -> list[int]:
    """`checksum` of each of the stretches that start at `firsts` (which has the end, too)."""
    held = memoryview(np.ascontiguousarray(ids, dtype="<u4")).cast("B")
    at = (firsts * 4).tolist()
    return [zlib.crc32(held[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
