"""Hashes of many documents compared without a row per hash.

Documents are dealt to chunks of a few MB of text. A chunk sends the distinct hashes of its windows,
sorted and packed, in one row per bucket of hashes; a bucket sees what all chunks hold, and answers every
such row with one bit per hash. Equal hashes of one chunk count once, so a passage that a third of all
documents shares costs a bucket one entry per chunk. The chunk, which computes its windows anew in the
same order, then reads the bits. Spark runs the rounds as one plan whose shuffle of the texts all
rounds read.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.arrays import pack_bits, pack_sorted, unpack_bits, unpack_sorted
from logloom.llm.tables import pieces, text_bytes, whole_text

#: Bytes of text in a chunk and, roughly, hashes in a bucket.
CHUNK_BYTES = 4 << 20
BUCKET_HASHES = 1 << 20

REQUESTS = "chunk bigint, bucket bigint, n bigint, hashes binary, extra binary"
REPLIES = "chunk bigint, bucket bigint, bits binary"


def chunked(docs: DataFrame, text: str, doc_id: str) -> tuple[DataFrame, int]:
    """(chunk, id, text, row): the documents by chunk, `row` with all their columns but the text, and the
    bytes of all texts.

    Rows of one doc_id share a chunk; those without one are dealt by their text.
    """
    total = text_bytes(docs, text)
    others = [F.col(f"`{c}`") for c in docs.columns if c != text]
    identity = F.col(doc_id).cast("bigint")
    body = whole_text(text)
    key = F.when(identity.isNull(), F.xxhash64(body)).otherwise(F.xxhash64(identity))
    return docs.select(
        F.pmod(key, F.lit(pieces(total, CHUNK_BYTES))).alias("chunk"), identity.alias("id"), body.alias("text"),
        F.struct(*others).alias("row"),
    ), total


def in_order(table: pa.Table) -> pa.Table:
    """The documents of a chunk by id, those without one last, and by text where ids are equal."""
    return table.combine_chunks().sort_by([("id", "ascending"), ("text", "ascending")])


class Requests:
    """Rows of one chunk: its distinct hashes by bucket."""

    def __init__(self, chunk: int, hashes: np.ndarray, buckets: np.ndarray, n_buckets: int,
                 also: np.ndarray | None = None):
        """`hashes` may be narrowed to what a bucket needs; `buckets` are those of the hashes. With `also`,
        pairs of a hash and its value there are told apart."""
        order = np.lexsort((hashes, buckets) if also is None else (also, hashes, buckets))
        new = np.ones(len(order), dtype=bool)
        h, b = hashes[order], buckets[order]
        new[1:] = (h[1:] != h[:-1]) | (b[1:] != b[:-1])
        if also is not None:
            new[1:] |= also[order][1:] != also[order][:-1]
            self.also = also[order][new]
        self.chunk, self.hashes, self.buckets = chunk, h[new], b[new]
        self.example = order[new]  # an occurrence of each distinct hash: the first, as the order is stable
        self.number = np.empty(len(order), dtype=np.int64)
        self.number[order] = np.cumsum(new) - 1  # distinct hash of every occurrence
        self.counts = np.bincount(self.number, minlength=len(self.hashes))
        self.edges = np.searchsorted(self.buckets, np.arange(n_buckets + 1))
        self.n_buckets = n_buckets

    def rows(self, extra: Callable[[slice], bytes]) -> pa.Table:
        """One row per bucket that holds any; `extra` packs what else the bucket needs to know."""
        held = np.flatnonzero(np.diff(self.edges))
        spans = [slice(int(self.edges[b]), int(self.edges[b + 1])) for b in held]
        return pa.table({
            "chunk": pa.array(np.full(len(held), self.chunk, np.int64)),
            "bucket": pa.array(held, pa.int64()),
            "n": pa.array([s.stop - s.start for s in spans], pa.int64()),
            "hashes": pa.array([pack_sorted(self.hashes[s]) for s in spans], pa.binary()),
            "extra": pa.array([extra(s) for s in spans], pa.binary()),
        })

    def answers(self, replies: pa.Table, width: int = 1) -> np.ndarray:
        """The bit of every distinct hash; with a `width` above one, as many rows of bits."""
        bits = np.zeros((width, len(self.hashes)), dtype=bool)
        for bucket, packed in zip(replies["bucket"].to_pylist(), replies["bits"].to_pylist(), strict=True):
            span = slice(int(self.edges[bucket]), int(self.edges[bucket + 1]))
            n = span.stop - span.start
            bits[:, span] = unpack_bits(packed, width * n).reshape(width, n)
        return bits[0] if width == 1 else bits


class Bucket:
    """What all chunks hold of one bucket, hash by hash."""

    def __init__(self, table: pa.Table, dtype):
        self.n = table["n"].to_pylist()
        self.chunks = table["chunk"].to_pylist()
        self.bucket = table["bucket"][0].as_py()
        hashes = np.concatenate([unpack_sorted(h, dtype) for h in table["hashes"].to_pylist()])
        self.order = np.argsort(hashes, kind="stable")
        in_order = hashes[self.order]
        new = np.ones(len(in_order), dtype=bool)
        new[1:] = in_order[1:] != in_order[:-1]
        self.firsts = np.flatnonzero(new)
        self.group = np.empty(len(in_order), dtype=np.int64)
        self.group[self.order] = np.cumsum(new) - 1

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Sum over all chunks, for every entry's hash."""
        return np.add.reduceat(values[self.order].astype(np.int64), self.firsts)[self.group]

    def replies(self, bits: np.ndarray) -> pa.Table:
        """One row per request; `bits` may have several rows, which follow each other."""
        bits = np.atleast_2d(bits)
        edges = np.concatenate([[0], np.cumsum(self.n)])
        return pa.table({
            "chunk": pa.array(self.chunks, pa.int64()),
            "bucket": pa.array(np.full(len(self.n), self.bucket), pa.int64()),
            "bits": pa.array([pack_bits(bits[:, a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)], pa.binary()),
        })


def ask(requests: DataFrame, resolve: Callable[[pa.Table], pa.Table]) -> DataFrame:
    """Answers of all buckets. Rows reach `resolve` in the order of chunks, so that a bucket answers alike
    however often, and wherever, Spark computes it."""
    return requests.groupBy("bucket").applyInArrow(lambda t: resolve(t.combine_chunks().sort_by("chunk")), REPLIES)


def with_answers(docs: DataFrame, answers: list[DataFrame], use, schema) -> DataFrame:
    """`use(documents of a chunk, its answers of every round)` for every chunk; a chunk without answers
    gets empty ones."""
    rounds = [a.select("chunk", F.lit(n).alias("round"), "bucket", "bits") for n, a in enumerate(answers)]
    replies, n_rounds = rounds[0], len(rounds)
    for more in rounds[1:]:
        replies = replies.unionByName(more)

    def merged(left: pa.Table, right: pa.Table) -> pa.Table:
        numbers = right["round"].to_numpy() if right.num_rows else np.zeros(0, np.int64)
        return use(in_order(left), [right.filter(pa.array(numbers == n)) for n in range(n_rounds)])

    return docs.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(merged, schema)

