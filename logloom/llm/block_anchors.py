"""Repeated passages of words, found by fixed blocks as anchors.

Every document is cut into blocks of half a window that do not overlap; their hashes are the index. Any
window that occurs twice holds such a block of its first occurrence, so probing the index with the hash
of every stretch of that length, at every word, meets all repeats. Around each hit the match is extended
window by window, as far as windows of the full length are found in another place as well: that gives
the maximal repeats. Of the places of a window the first one, in the order of documents, stays.

Both rounds run over `exchange`: distinct hashes of chunks of documents, so a passage copied any number
of times makes no pairs. Probes travel as 32 bits besides their bucket, since a false hit only costs
work; windows as 64 bits besides a bucket taken from another polynomial.

Order: by doc_id, NULL last; rows that share a doc_id follow each other by text, and are compared as
documents of their own, as are repeated rows, of which the first stays. NULL and empty texts, and those
shorter than a window, keep all they have. An empty table gives an empty one.
"""

from __future__ import annotations

from hashlib import sha256
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm import exchange as ex
from logloom.llm.tables import pieces
from logloom.llm.arrays import (
    covered, from_planes, inside_texts, pack_bits, to_planes, unpack_bits, utf8, word_bounds, word_hashes,
    word_prefixes,
)

#: Words of a repeat that counts.
WINDOW = 20

_NO_ID = np.int64((1 << 63) - 1)


class _Words:
    """The words of a chunk and their hashes."""

    def __init__(self, table: pa.Table, window: int):
        self.offsets, self.data = utf8(table["text"])
        self.starts, self.ends, self.firsts = word_bounds(self.offsets, self.data)
        self.n = len(self.starts)
        hashes = word_hashes(self.data, self.starts, self.ends)
        self.prefixes, self.second = word_prefixes(hashes), word_prefixes(hashes, second=True)
        self.window, self.block = window, window // 2

    def probes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Position and hash of every stretch of a block's length, and whether it is a block."""
        hashes = self.prefixes.windows(self.block)
        at = np.flatnonzero(inside_texts(self.firsts, self.block, len(hashes)))
        first = np.repeat(self.firsts[:-1], np.diff(self.firsts))
        return at, hashes[at], (at - first[at]) % self.block == 0

    def windows(self) -> np.ndarray:
        """Which positions start a window."""
        return inside_texts(self.firsts, self.window, max(self.n - self.window + 1, 0))


def _narrow(hashes: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    return (hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32), _bucket(hashes, n_buckets)


def _bucket(hashes: np.ndarray, n_buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) % np.uint64(n_buckets)).astype(np.int64)


def _first_round(words: _Words, chunk: int, n_buckets: int) -> tuple[ex.Requests, np.ndarray, np.ndarray]:
    at, hashes, is_block = words.probes()
    return ex.Requests(chunk, *_narrow(hashes, n_buckets), n_buckets), at, is_block


def _hits(replies: pa.Table) -> pa.Table:
    """A probe is met if it is a block somewhere and found in two places."""
    bucket = ex.Bucket(replies, np.uint32)
    many, block = [], []
    for packed, n in zip(replies["extra"].to_pylist(), replies["n"].to_pylist(), strict=True):
        half = (n + 7) // 8
        many.append(unpack_bits(packed[:half], n))
        block.append(unpack_bits(packed[half:], n))
    places = bucket.sums(1 + np.concatenate(many))
    return bucket.replies((places >= 2) & (bucket.sums(np.concatenate(block)) > 0))


def _second_round(words: _Words, chunk: int, n_buckets: int, hits: pa.Table) -> tuple[ex.Requests, np.ndarray]:
    """Windows that hold a hit, in the order of the documents."""
    requests, at, _ = _first_round(words, chunk, n_buckets)
    met = np.zeros(words.n + 1, dtype=np.int64)
    met[at] = requests.answers(hits)[requests.number] if len(at) else 0
    sums = np.concatenate([[0], np.cumsum(met)])
    start = np.flatnonzero(words.windows())
    reach = words.window - words.block + 1
    start = start[sums[start + reach] > sums[start]]
    hashes = words.prefixes.windows(words.window)[start]
    other = words.second.windows(words.window)[start]
    return ex.Requests(chunk, hashes, _bucket(other, n_buckets), n_buckets), start


def _ids(words: _Words, table: pa.Table) -> np.ndarray:
    """Two sort keys of every document: id, and the hash of the text for those without id."""
    ids = table["id"].fill_null(int(_NO_ID)).to_numpy()
    unnamed = np.flatnonzero(table["id"].is_null().to_numpy(zero_copy_only=False))
    keys = np.zeros((2, len(ids)), dtype=np.int64)
    keys[0] = ids
    for n in unnamed:
        text = words.data[words.offsets[n]: words.offsets[n + 1]].tobytes()
        keys[1, n] = int.from_bytes(sha256(text).digest()[:7], "big")
    return keys


def _owners(replies: pa.Table) -> pa.Table:
    """A chunk has lost a window if another one has it in an earlier document."""
    bucket = ex.Bucket(replies, np.uint64)
    keys = np.concatenate([from_planes(e, np.int64).reshape(2, -1) for e in replies["extra"].to_pylist()], axis=1)
    order = np.lexsort((keys[1], keys[0], bucket.group))
    first = np.ones(len(order), dtype=bool)
    first[1:] = bucket.group[order][1:] != bucket.group[order][:-1]
    lost = np.ones(len(order), dtype=bool)
    lost[order[first]] = False
    return bucket.replies(lost)


def _removed(words: _Words, chunk: int, n_buckets: int, hits: pa.Table, lost: pa.Table) -> np.ndarray:
    """Which words go."""
    requests, start = _second_round(words, chunk, n_buckets, hits)
    if not len(start):
        return np.zeros(words.n, dtype=bool)
    later = np.ones(len(start), dtype=bool)
    later[requests.example] = requests.answers(lost)
    return covered(start[later], words.window, words.n)


def _with_kept(docs: DataFrame, text: str, doc_id: str, window: int, keep, schema) -> DataFrame:
    """Run both rounds and build each chunk's result by `keep(table, words, removed)`."""
    if window < 2:
        raise ValueError("a window has at least two words")
    rows, total = ex.chunked(docs, text, doc_id)
    n_buckets = pieces(total, 6 * ex.BUCKET_HASHES)

    def probe(table: pa.Table) -> pa.Table:
        table = ex.in_order(table)
        requests, _, is_block = _first_round(_Words(table, window), table["chunk"][0].as_py(), n_buckets)
        block = np.zeros(len(requests.hashes), dtype=bool)
        block[requests.number[is_block]] = True
        return requests.rows(lambda s: pack_bits(requests.counts[s] > 1) + pack_bits(block[s]))

    def claim(table: pa.Table, replies: list[pa.Table]) -> pa.Table:
        words = _Words(table, window)
        requests, start = _second_round(words, table["chunk"][0].as_py(), n_buckets, replies[0])
        of = np.searchsorted(words.firsts, start[requests.example], side="right") - 1
        keys = _ids(words, table)[:, of]
        return requests.rows(lambda s: to_planes(np.ascontiguousarray(keys[:, s]).ravel()))

    def finish(table: pa.Table, replies: list[pa.Table]) -> pa.Table:
        words = _Words(table, window)
        return keep(table, words, _removed(words, table["chunk"][0].as_py(), n_buckets, *replies))

    hits = ex.ask(rows.groupBy("chunk").applyInArrow(probe, ex.REQUESTS), _hits)
    lost = ex.ask(ex.with_answers(rows, [hits], claim, ex.REQUESTS), _owners)
    return ex.with_answers(rows, [hits, lost], finish, schema)


def repeat_digests(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and the SHA-256 of the words that stay, joined by spaces."""

    def keep(table: pa.Table, words: _Words, removed: np.ndarray) -> pa.Table:
        held, edges, firsts = words.data.tobytes(), words.offsets.tolist(), words.firsts.tolist()
        digests = []
        for n in range(table.num_rows):
            found = held[edges[n]: edges[n + 1]].split()
            gone = removed[firsts[n]: firsts[n + 1]]
            digests.append(sha256(b" ".join(compress(found, ~gone) if gone.any() else found)).hexdigest())
        sums = np.concatenate([[0], np.cumsum(removed)])
        return pa.table({
            "doc_id": table["id"],
            "n_words": pa.array(np.diff(words.firsts), pa.int64()),
            "n_removed": pa.array(np.diff(sums[words.firsts]), pa.int64()),
            "kept_sha256": pa.array(digests, pa.string()),
        })

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return _with_kept(rows, "text", "doc_id", window, keep,
                      "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string")


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """The documents with their columns; from their texts each removed word goes, with what follows it up
    to the next word. A text that loses nothing stays as it is, NULL included."""
    fields = [f for f in docs.schema if f.name != text]

    def keep(table: pa.Table, words: _Words, removed: np.ndarray) -> pa.Table:
        # A word's stretch runs to the next word of its text, or to the text's end.
        last = np.zeros(words.n, dtype=bool)
        filled = np.diff(words.firsts) > 0
        last[words.firsts[1:][filled] - 1] = True
        ends = np.append(words.starts[1:], 0)
        ends[last] = words.offsets[1:][filled]
        change = np.zeros(len(words.data) + 1, dtype=np.int32)
        np.add.at(change, words.starts[removed], 1)
        np.add.at(change, ends[removed], -1)
        stays = np.cumsum(change[:-1]) == 0
        sums = np.concatenate([[0], np.cumsum(stays)])
        texts = pa.Array.from_buffers(pa.large_string(), table.num_rows, [
            None, pa.py_buffer(sums[words.offsets].astype(np.int64)), pa.py_buffer(words.data[stays])])
        return pa.table({"row": table["row"], "text": texts.cast(pa.string())})

    rows = docs.withColumn("_null", F.col(text).isNull())
    result = _with_kept(rows, text, doc_id, window, keep, _row_schema(rows, text))
    body = F.when(~F.col("row._null") | (F.col("text") != ""), F.col("text"))
    kept = {f.name: F.col(f"row.`{f.name}`") for f in fields}
    return result.select(*[(body if c == text else kept[c]).alias(c) for c in docs.columns])


def _row_schema(rows: DataFrame, text: str):
    return rows.select(
        F.struct(*[F.col(f"`{c}`") for c in rows.columns if c != text]).alias("row"), F.lit("").alias("text")).schema
