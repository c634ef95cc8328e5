"""Fixed-length training sequences whose documents resemble their neighbours.

A document's words are hashed to a signed vector, which a fixed matrix projects to four dimensions;
each is cut to 8 bits by its place in a normal distribution, and the Hilbert curve through these four
numbers gives the document one key. Documents are sorted by key in ranges, and every range is one
stream of ids, cut into sequences of `LENGTH` without regard to documents. What remains at the end of a
range is cut into powers of two, so no sequence needs padding.

NULL and empty texts are documents of the end id only, repeated rows documents of their own; documents
with equal keys, as copies have, follow each other in the order of doc_id (NULL first) and text hash. An
empty table gives no pieces. Input columns other than the id and the text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.arrays import blocks, word_bounds, word_hashes
from logloom.llm.byte_tokens import encoder
from logloom.llm.tables import pieces, text_bytes, whole_text

LENGTH = 1024
#: Bytes of text a task packs into one stream.
TASK_BYTES = 16 << 20
#: Components of the hashed vector, dimensions of the curve and bits of each.
HASHED, DIMENSIONS, BITS = 16, 4, 8
_PASS_BYTES = 4 << 20

PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
    "offset bigint, ids binary"
)
_PROJECTION = np.random.Generator(np.random.PCG64(11)).normal(size=(HASHED, DIMENSIONS)) / np.sqrt(HASHED)


def hashed_vectors(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Signed sums of word hashes, scaled by the root of the number of words; a text without words has
    the zero vector."""
    starts, ends, firsts = word_bounds(offsets, data)
    signs = np.unpackbits(word_hashes(data, starts, ends).view(np.uint8).reshape(-1, 8)[:, : HASHED // 8], axis=1)
    sums = np.zeros((len(signs) + 1, HASHED), dtype=np.int64)
    np.cumsum(signs, axis=0, out=sums[1:])
    n = np.diff(firsts)
    ones = sums[firsts[1:]] - sums[firsts[:-1]]
    return (2 * ones - n[:, None]) / np.sqrt(np.maximum(n, 1))[:, None]


def hilbert_keys(vectors: np.ndarray) -> np.ndarray:
    """Place of each vector on the Hilbert curve through its projection."""
    x = vectors @ _PROJECTION
    share = 1 / (1 + np.exp(-1.702 * x))  # near the normal distribution's
    axes = np.minimum(share * (1 << BITS), (1 << BITS) - 1).astype(np.uint32)
    return _along_curve(axes)


def _along_curve(axes: np.ndarray) -> np.ndarray:
    """Hilbert index of points on a grid: from the coarsest bit down, a set bit of an axis turns the lower
    bits of the first axis, a clear one swaps them with its own; Gray coding of the bits ends it."""
    x = axes.copy()
    bit = np.uint32(1 << (BITS - 1))
    while bit > 1:
        low = bit - np.uint32(1)
        for d in range(DIMENSIONS):
            is_set = (x[:, d] & bit) > 0
            swapped = np.where(is_set, 0, (x[:, 0] ^ x[:, d]) & low).astype(np.uint32)
            x[:, 0] ^= np.where(is_set, low, swapped)
            x[:, d] ^= swapped
        bit >>= np.uint32(1)
    for d in range(1, DIMENSIONS):
        x[:, d] ^= x[:, d - 1]
    turned = np.zeros(len(x), dtype=np.uint32)
    bit = np.uint32(1 << (BITS - 1))
    while bit > 1:
        turned ^= np.where(x[:, -1] & bit, bit - np.uint32(1), np.uint32(0)).astype(np.uint32)
        bit >>= np.uint32(1)
    x ^= turned[:, None]
    key = np.zeros(len(x), dtype=np.int64)
    for b in reversed(range(BITS)):
        for d in range(DIMENSIONS):
            key = (key << 1) | ((x[:, d] >> np.uint32(b)) & 1)
    return key


def with_curve_key(rows: DataFrame) -> DataFrame:
    """Rows (doc_id, text) with the key of their text."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, offsets, data in blocks(batches, "text"):
            key = hilbert_keys(hashed_vectors(offsets, data))
            yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(key)], [*piece.schema.names, "key"])

    return rows.mapInArrow(keyed, "doc_id bigint, text string, key bigint")


class _Stream:
    """Cuts one stream of documents into pieces of sequences."""

    def __init__(self, part: int, with_ids: bool):
        self.sequence, self.with_ids = part << 32, with_ids
        self.filled = 0
        self.open: list[tuple] = []  # pieces of the sequence being filled

    def add(self, doc_id, ids: np.ndarray) -> Iterator[tuple]:
        at = 0
        while at < len(ids):
            take = min(len(ids) - at, LENGTH - self.filled)
            self.open.append((doc_id, at, ids[at: at + take], len(ids)))
            self.filled += take
            at += take
            if self.filled == LENGTH:
                yield from self._close(LENGTH)

    def end(self) -> Iterator[tuple]:
        """The rest in sequences of powers of two, the largest first."""
        while self.filled:
            yield from self._close(1 << (self.filled.bit_length() - 1))

    def _close(self, size: int) -> Iterator[tuple]:
        offset, rest = 0, []
        for doc_id, start, ids, total in self.open:
            take = min(len(ids), size - offset)
            if take:
                held = ids[:take].astype("<u4").tobytes()
                yield (doc_id, start, take, zlib.crc32(held), total, self.sequence, offset,
                       held if self.with_ids else None)
                offset += take
            if take < len(ids):
                rest.append((doc_id, start + take, ids[take:], total))
        self.open, self.filled, self.sequence = rest, self.filled - size, self.sequence + 1


def pack_along_curve(docs: DataFrame, tokenizer: str, text: str = "text", doc_id: str = "doc_id",
                     with_ids: bool = True) -> DataFrame:
    """Pieces of documents in sequences: doc_id, start (its ids before the piece), length, ids_crc32,
    doc_tokens, sequence_id, offset in the sequence and, on wish, the ids (little-endian, 32 bits).

    Texts move once, to the task of their range of keys; that task encodes and packs them.
    """
    schema = pa.schema([
        ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary()),
    ])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = _Stream(TaskContext.get().partitionId(), with_ids)

        def out(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), schema, strict=True)], schema=schema)

        for rows, offsets, data in blocks(batches, "text", _PASS_BYTES):
            ids, firsts = encoder(tokenizer).encode(offsets, data)
            edges = firsts.tolist()
            found = [
                p for n, i in enumerate(rows.column("doc_id").to_pylist())
                for p in stream.add(i, ids[edges[n]: edges[n + 1]])
            ]
            if found:
                yield out(found)
        if found := list(stream.end()):
            yield out(found)

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), whole_text(text).alias("text"))
    order = ["key", "doc_id", F.xxhash64("text")]
    packed = (
        with_curve_key(rows).repartitionByRange(pieces(text_bytes(docs, text), TASK_BYTES), *order)
        .sortWithinPartitions(*order)
        .mapInArrow(pack, PIECES)
    )
    return packed if with_ids else packed.drop("ids")
