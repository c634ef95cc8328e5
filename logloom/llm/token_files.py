"""Token ids of documents in compressed files, and back.

A file set is a Parquet dataset. Each of its rows is a segment of whole documents in ascending order:
their ids and lengths, the frequency table the segment's blocks share, the blocks themselves (static
range asymmetric numeral system, see `rans`) and a checkpoint per block: first id, first word, crc32.
A segment, and within it any block, decodes by itself, so a damaged or lost piece costs no other.

Order: by doc_id, NULL first; rows that share a doc_id by the hash of their text. Repeated rows are
documents of their own, one behind the other. A NULL or empty text holds the end id only. An empty
table gives a file set without segments. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logloom.llm import rans
from logloom.llm.arrays import blocks
from logloom.llm.byte_tokens import encoder
from logloom.llm.tables import pieces, text_bytes, whole_text

#: Bytes of text a task takes, and ids a segment holds (a longer document is a segment of its own).
TASK_BYTES = 16 << 20
SEGMENT_IDS = 1 << 22
_PASS_BYTES = 4 << 20

SEGMENTS = (
    "part int, segment int, n_tokens bigint, doc_ids array<bigint>, lengths array<int>, symbols binary, "
    "frequencies binary, first_ids array<bigint>, first_words array<bigint>, crc32s array<bigint>, "
    "states binary, words binary"
)
DOCUMENTS = "part int, segment int, doc_id bigint, inside bigint, n_tokens bigint, ids_crc32 bigint, ids binary"
_LENGTHS = pa.list_(pa.int32())
_LONGS = pa.list_(pa.int64())


def _segment(part: int, number: int, doc_ids: list, lengths: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    table = rans.Table.of(ids)
    states, words, first_words, crcs = [], [], [0], []
    first_ids = list(range(0, len(ids), rans.BLOCK_IDS))
    for first in first_ids:
        block = ids[first: first + rans.BLOCK_IDS]
        state, written = rans.encode_block(block, table)
        states.append(state)
        words.append(written)
        first_words.append(first_words[-1] + len(written))
        crcs.append(rans.checksum(block))
    return pa.record_batch({
        "part": pa.array([part], pa.int32()),
        "segment": pa.array([number], pa.int32()),
        "n_tokens": pa.array([len(ids)], pa.int64()),
        "doc_ids": pa.array([doc_ids], _LONGS),
        "lengths": pa.array([lengths], _LENGTHS),
        "symbols": [table.symbols.astype("<u4").tobytes()],
        "frequencies": [table.frequencies.astype("<u4").tobytes()],
        "first_ids": pa.array([first_ids], _LONGS),
        "first_words": pa.array([first_words[:-1]], _LONGS),
        "crc32s": pa.array([crcs], _LONGS),
        "states": [np.concatenate(states).astype("<u8").tobytes()],
        "words": [np.concatenate(words).astype("<u4").tobytes()],
    })


def write_token_files(docs: DataFrame, path: str, tokenizer: str, text: str = "text", doc_id: str = "doc_id") -> None:
    """Encode whole texts and write the file set. The only shuffle sorts the texts into ranges of doc_id."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        doc_ids: list = []
        lengths, ids, n = [], [], 0
        for rows, offsets, data in blocks(batches, "text", _PASS_BYTES):
            found, firsts = encoder(tokenizer).encode(offsets, data)
            doc_ids += rows.column("doc_id").to_pylist()
            lengths.append(np.diff(firsts))
            ids.append(found)
            n += len(found)
            if n >= SEGMENT_IDS:
                yield _segment(part, number, doc_ids, np.concatenate(lengths), np.concatenate(ids))
                doc_ids, lengths, ids, n, number = [], [], [], 0, number + 1
        if doc_ids:
            yield _segment(part, number, doc_ids, np.concatenate(lengths), np.concatenate(ids))

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), whole_text(text).alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    (
        rows.repartitionByRange(pieces(text_bytes(docs, text), TASK_BYTES), *order)
        .sortWithinPartitions(*order)
        .mapInArrow(encode, SEGMENTS).write.parquet(path)
    )


def read_token_files(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """One row per document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and,
    on wish, its ids as little-endian unsigned 32-bit integers. A block whose checksum differs fails."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = decode_segment(row)
                lengths = np.array(row["lengths"], np.int64)
                firsts = np.concatenate([[0], np.cumsum(lengths)])
                n = len(lengths)
                data = ids.astype("<u4")
                yield pa.record_batch({
                    "part": pa.array(np.full(n, row["part"], np.int32)),
                    "segment": pa.array(np.full(n, row["segment"], np.int32)),
                    "doc_id": pa.array(row["doc_ids"], pa.int64()),
                    "inside": firsts[:-1],
                    "n_tokens": lengths,
                    "ids_crc32": pa.array(rans.checksums(ids, firsts), pa.int64()),
                    "ids": pa.array([data[a:b].tobytes() for a, b in zip(firsts[:-1], firsts[1:], strict=True)]
                                    if with_ids else [None] * n, pa.binary()),
                })

    # No type inference: an empty file set has no file to infer from.
    segments = spark.read.schema(SEGMENTS).parquet(path)
    found = segments.mapInArrow(decode, DOCUMENTS)
    # One row per segment, so the running sum over all of them stays narrow and short.
    earlier = W.orderBy("part", "segment").rowsBetween(W.unboundedPreceding, -1)
    starts = segments.select(
        "part", "segment", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)).alias("before"))
    columns = ["doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"]
    return found.join(starts, ["part", "segment"]).select(*columns, *(["ids"] if with_ids else []))


def decode_segment(row: dict) -> np.ndarray:
    """Ids of one segment; every block is checked against its checkpoint."""
    table = rans.Table(np.frombuffer(row["symbols"], "<u4"), np.frombuffer(row["frequencies"], "<u4"))
    slots = rans.slot_table(table)
    states = np.frombuffer(row["states"], "<u8").reshape(-1, rans.LANES)
    words = np.frombuffer(row["words"], "<u4")
    id_edges = [*row["first_ids"], row["n_tokens"]]
    word_edges = [*row["first_words"], len(words)]
    out = []
    for n, crc in enumerate(row["crc32s"]):
        ids = rans.decode_block(
            id_edges[n + 1] - id_edges[n], states[n], words[word_edges[n]: word_edges[n + 1]], table, slots)
        if rans.checksum(ids) != crc:
            raise ValueError(f"damaged block {n} of segment {row['part']}/{row['segment']}")
        out.append(ids)
    return np.concatenate(out)
