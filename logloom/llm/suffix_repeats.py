"""Repeated stretches of bytes, found by sorting suffixes whose comparison is by hash.

1. Anchors. Of the stretches of half a window that start in a window, the one of the smallest hash is its
   anchor, so equal windows have equal anchors at equal places, and one document in a hundred bytes
   has one. Consecutive windows with one anchor are a run; the bytes they cover are its context.
2. A first round over `exchange` tells for every anchor whether it occurs in two places, and for its
   context whether that does. Where the context does, all windows of the run are repeated; where the
   anchor is alone, none is. What remains are the anchors near an edge of a repeat.
3. Their contexts, one of each, go to the bucket of their anchor. There the suffixes from the anchors on
   are sorted: a merge sort, each of whose comparisons finds the common extension of two suffixes by
   binary search over prefix polynomial hashes. The common extensions of neighbours are then held against
   the bytes, and corrected where a hash has collided. Two windows with x bytes before their anchors are
   equal if the sorted suffixes between them share the rest of the window, and the x bytes agree.
4. An anchor with more than `HOT` contexts would not fit a task; the windows of its runs are
   compared by their hashes, distinct ones per chunk, which any number of them allows.

Every byte in a window that also starts elsewhere goes, in all places, whatever the order of documents.
Matches do not cross documents. NULL and empty texts have no bytes; repeated rows repeat each other, and
so go where they are long enough. An empty table gives an empty result.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm import exchange as ex
from logloom.llm.arrays import (
    Prefixes, byte_prefixes, covered, from_planes, mix, pack_bits, to_planes, unpack_bits, unpack_sorted, utf8,
)
from logloom.llm.tables import pieces

#: Bytes of a repeat that counts.
WINDOW = 400
#: Distinct contexts of one anchor that a task sorts.
HOT = 20_000

_SECOND = 0xE7037ED1A0B428DB
CONTEXTS = "chunk bigint, bucket bigint, sizes binary, places binary, runs binary, anchors binary, text binary"


def _values(data: np.ndarray) -> np.ndarray:
    return mix(data.astype(np.uint64) + np.uint64(1))


class _Runs:
    """The anchors of a chunk: place, first and last window of the run."""

    def __init__(self, table: pa.Table, window: int):
        self.offsets, self.data = utf8(table["text"])
        self.window, self.half = window, window // 2
        self.prefixes = byte_prefixes(self.data)
        self.anchor, self.first, self.last = self._select()

    def _select(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = len(self.data) - self.window + 1
        whole = np.zeros(max(n, 0), dtype=bool)
        for a, b in zip(self.offsets[:-1].tolist(), self.offsets[1:].tolist(), strict=True):
            whole[a: max(b - self.window + 1, a)] = True
        starts = np.flatnonzero(whole)
        if not len(starts):
            return (np.zeros(0, np.int64),) * 3
        # Hash above, place below, so that the smallest number is the leftmost smallest hash.
        bits = np.uint64(len(self.data).bit_length())
        low = self.prefixes.windows(self.half)
        low = ((low >> bits) << bits) | np.arange(len(low), dtype=np.uint64)
        span, reach = self.window - self.half + 1, 1
        while reach < span:  # the smallest of the next `reach` numbers, for doubling reaches
            step = min(reach, span - reach)
            low = np.minimum(low[:-step], low[step:])
            reach += step
        anchor = (low[starts] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        edge = np.ones(len(starts), dtype=bool)
        edge[1:] = (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)
        at = np.flatnonzero(edge)
        return anchor[at], starts[at], starts[np.append(at[1:], len(starts)) - 1]

    def requests(self, chunk: int, n_buckets: int) -> ex.Requests:
        """Anchors with their contexts; the place of the anchor and the length tell contexts apart, too."""
        anchors = mix(self.prefixes.of(self.anchor, self.anchor + self.half))
        contexts = self.prefixes.of(self.first, self.last + self.window)
        shape = (self.anchor - self.first).astype(np.uint64) << np.uint64(32) | (self.last - self.first).astype(np.uint64)
        return ex.Requests(chunk, anchors, _bucket(anchors, n_buckets), n_buckets, mix(contexts ^ mix(shape)))

    def windows(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the windows of some runs, run by run, and their number per run."""
        n = self.last[runs] - self.first[runs] + 1
        return np.arange(int(n.sum())) + np.repeat(self.first[runs] - (np.cumsum(n) - n), n), n


def _bucket(hashes: np.ndarray, n_buckets: int) -> np.ndarray:
    return (mix(hashes) % np.uint64(n_buckets)).astype(np.int64)


def _judge(table: pa.Table, hot: int) -> pa.Table:
    """For each anchor with its context, three bits: the context occurs in two places; this chunk has to
    send it; there are too many contexts to sort."""
    bucket = ex.Bucket(table, np.uint64)
    contexts, many = [], []
    for packed, n in zip(table["extra"].to_pylist(), table["n"].to_pylist(), strict=True):
        contexts.append(from_planes(packed[: 8 * n], np.uint64))
        many.append(unpack_bits(packed[8 * n:], n))
    contexts, places = np.concatenate(contexts), 1 + np.concatenate(many).astype(np.int64)
    order = np.lexsort((contexts, bucket.group))
    group, context = bucket.group[order], contexts[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (group[1:] != group[:-1]) | (context[1:] != context[:-1])
    pair = np.cumsum(new) - 1
    twice = np.zeros(len(order), dtype=bool)
    twice[order] = (np.bincount(pair, places[order]) >= 2)[pair]
    first = np.zeros(len(order), dtype=bool)
    first[order] = new  # of the chunks that hold a context, one sends it
    distinct = bucket.sums(first)
    return bucket.replies(np.stack([twice, first & (distinct > 1), distinct > hot]))


def _twice(table: pa.Table) -> pa.Table:
    """Hashes found in two places."""
    bucket = ex.Bucket(table, np.uint64)
    many = np.concatenate([
        unpack_bits(e, n) for e, n in zip(table["extra"].to_pylist(), table["n"].to_pylist(), strict=True)])
    return bucket.replies(bucket.sums(1 + many) >= 2)


class Suffixes:
    """Suffixes of a text, each up to an end of its own, compared by hash."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        self.data, self.starts, self.ends = data, starts, ends
        self.prefixes = Prefixes(_values(data), _SECOND)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension of suffixes, by binary search over the prefix hashes."""
        s, t = self.starts[a], self.starts[b]
        low = np.zeros(len(a), dtype=np.int64)
        high = np.minimum(self.ends[a] - s, self.ends[b] - t)
        top = int(high.max()) if len(high) else 0
        for _ in range(top.bit_length()):
            middle = (low + high + 1) >> 1
            same = self.prefixes.of(s, s + middle) == self.prefixes.of(t, t + middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def less(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether one suffix sorts strictly before the other; the end sorts before any byte."""
        n = self.common(a, b)
        byte = lambda x: np.where(
            self.starts[x] + n < self.ends[x], self.data[np.minimum(self.starts[x] + n, len(self.data) - 1)].astype(np.int64), -1)
        return byte(a) < byte(b)

    def sort(self, group: np.ndarray) -> np.ndarray:
        """Order of the suffixes by group, and within one by text: merges of runs of doubling length, all
        runs of all groups at once; each suffix looks up its place in the run beside its own."""
        order = np.argsort(group, kind="stable")
        sizes = np.bincount(group)
        first = np.repeat(np.cumsum(sizes) - sizes, sizes)
        size = np.repeat(sizes, sizes)
        width = 1
        while width < sizes.max(initial=0):
            rank = np.arange(len(order)) - first
            beside = (rank // width) ^ 1
            low = np.minimum(beside * width, size)
            high = np.minimum(low + width, size)
            begin = low.copy()
            right = beside % 2 == 0  # this suffix is in the right run, so equal ones go before it
            open_ = np.flatnonzero(low < high)
            while len(open_):
                middle = (low[open_] + high[open_]) >> 1
                own, other = order[open_], order[first[open_] + middle]
                before = np.where(right[open_], ~self.less(own, other), self.less(other, own))
                low[open_] = np.where(before, middle + 1, low[open_])
                high[open_] = np.where(before, high[open_], middle)
                open_ = open_[low[open_] < high[open_]]
            moved = np.empty_like(order)
            moved[first + (rank // (2 * width)) * (2 * width) + rank % width + (low - begin)] = order
            order = moved
            width *= 2
        return order

    def extensions(self, order: np.ndarray) -> np.ndarray:
        """Common extension of each sorted suffix with the one before it, held against the bytes."""
        a, b = order[:-1], order[1:]
        n = self.common(a, b)
        at = np.repeat(np.cumsum(n) - n, n)
        inside = np.arange(int(n.sum())) - at
        differ = self.data[np.repeat(self.starts[a], n) + inside] != self.data[np.repeat(self.starts[b], n) + inside]
        wrong = np.flatnonzero(differ)
        pair = np.repeat(np.arange(len(n)), n)[wrong]
        np.minimum.at(n, pair, inside[wrong])
        return np.concatenate([[0], n]) if len(order) else n


def _sort_contexts(table: pa.Table, window: int) -> pa.Table:
    """Sort a bucket's contexts from their anchors on and find the windows that two of them share."""
    numbers = lambda name: [np.frombuffer(x, "<u4").astype(np.int64) for x in table[name].to_pylist()]
    per_row = numbers("runs")
    sizes, places, runs = (np.concatenate(x) for x in (numbers("sizes"), numbers("places"), per_row))
    anchors = np.concatenate([unpack_sorted(x, np.uint64) for x in table["anchors"].to_pylist()])
    data = np.frombuffer(b"".join(table["text"].to_pylist()), np.uint8)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    suffixes = Suffixes(data, starts + places, ends)
    group = np.unique(anchors, return_inverse=True)[1]
    order = suffixes.sort(group)
    common = suffixes.extensions(order)
    common[1:][group[order[1:]] != group[order[:-1]]] = 0
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    # Windows: the run of a context starts with it.
    of = np.repeat(np.arange(len(runs)), runs)
    inside = np.arange(len(of)) - np.repeat(np.cumsum(runs) - runs, runs)
    before = places[of] - inside
    block = np.zeros(len(of), dtype=np.int64)
    by_length = np.argsort(before, kind="stable")
    lengths, first = np.unique(before[by_length], return_index=True)
    for x, windows in zip(lengths.tolist(), np.split(by_length, first[1:]), strict=True):
        block[windows] = np.cumsum(common < window - x)[rank[of[windows]]]
    at = starts[of] + inside
    left = suffixes.prefixes.of(at, at + before)
    key = mix(left ^ mix(block.astype(np.uint64) << np.uint64(16) | before.astype(np.uint64)))
    _, number, counts = np.unique(key, return_inverse=True, return_counts=True)
    twice = counts[number] >= 2
    edges = np.concatenate([[0], np.cumsum([int(r.sum()) for r in per_row])])
    return pa.table({
        "chunk": table["chunk"], "bucket": table["bucket"],
        "bits": pa.array([pack_bits(twice[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)], pa.binary()),
    })


class _Chunk:
    """What a chunk knows after the first round."""

    def __init__(self, table: pa.Table, window: int, n_buckets: int, replies: pa.Table):
        self.runs = _Runs(table, window)
        self.n_buckets = n_buckets
        self.requests = self.runs.requests(table["chunk"][0].as_py(), n_buckets)
        self.twice, send, hot = self.requests.answers(replies, 3)
        self.sorted = np.flatnonzero(send & ~hot)
        self.counted = np.flatnonzero(send & hot)

    def contexts(self) -> pa.Table:
        """The contexts to sort, in one row per bucket."""
        runs, req = self.runs, self.requests
        example = req.example[self.sorted]
        first, last = runs.first[example], runs.last[example] + runs.window
        edges = np.searchsorted(req.buckets[self.sorted], np.arange(self.n_buckets + 1))
        held = np.flatnonzero(np.diff(edges))
        spans = [slice(int(edges[b]), int(edges[b + 1])) for b in held]
        u4 = lambda x: [x[s].astype("<u4").tobytes() for s in spans]
        data = runs.data.tobytes()
        return pa.table({
            "chunk": pa.array(np.full(len(held), req.chunk, np.int64)),
            "bucket": pa.array(held, pa.int64()),
            "sizes": pa.array(u4(last - first), pa.binary()),
            "places": pa.array(u4(runs.anchor[example] - first), pa.binary()),
            "runs": pa.array(u4(runs.last[example] - first + 1), pa.binary()),
            "anchors": pa.array([ex.pack_sorted(req.hashes[self.sorted][s]) for s in spans], pa.binary()),
            "text": pa.array([b"".join(
                data[a:b] for a, b in zip(first[s].tolist(), last[s].tolist(), strict=True)) for s in spans], pa.binary()),
        })

    def hashes(self) -> tuple[ex.Requests, np.ndarray]:
        """The windows to count, and where they start."""
        at, _ = self.runs.windows(self.requests.example[self.counted])
        hashes = mix(self.runs.prefixes.of(at, at + self.runs.window))
        buckets = _bucket(Prefixes(_values(self.runs.data), _SECOND).of(at, at + self.runs.window), self.n_buckets)
        return ex.Requests(self.requests.chunk, hashes, buckets, self.n_buckets), at

    def repeated(self, sorted_: pa.Table, counted: pa.Table) -> np.ndarray:
        """Which bytes go."""
        runs, req = self.runs, self.requests
        found = [runs.windows(np.flatnonzero(self.twice[req.number]))[0]] if len(req.number) else []
        example = req.example[self.sorted]
        edges = np.searchsorted(req.buckets[self.sorted], np.arange(self.n_buckets + 1))
        for bucket, bits in zip(sorted_["bucket"].to_pylist(), sorted_["bits"].to_pylist(), strict=True):
            at, n = runs.windows(example[edges[bucket]: edges[bucket + 1]])
            found.append(at[unpack_bits(bits, int(n.sum()))])
        if len(self.counted):
            requests, at = self.hashes()
            found.append(at[requests.answers(counted)[requests.number]])
        starts = np.concatenate(found) if found else np.zeros(0, np.int64)
        return covered(starts, runs.window, len(runs.data))


def _with_kept(docs: DataFrame, text: str, doc_id: str, window: int, hot: int, keep, schema) -> DataFrame:
    if window < 2:
        raise ValueError("a window has at least two bytes")
    rows, total = ex.chunked(docs, text, doc_id)
    n_buckets = pieces(total, 4 * ex.CHUNK_BYTES)

    def probe(table: pa.Table) -> pa.Table:
        requests = _Runs(ex.in_order(table), window).requests(table["chunk"][0].as_py(), n_buckets)
        return requests.rows(lambda s: to_planes(requests.also[s]) + pack_bits(requests.counts[s] > 1))

    def contexts(table: pa.Table, replies: list[pa.Table]) -> pa.Table:
        return _Chunk(table, window, n_buckets, replies[0]).contexts()

    def hashes(table: pa.Table, replies: list[pa.Table]) -> pa.Table:
        requests, _ = _Chunk(table, window, n_buckets, replies[0]).hashes()
        return requests.rows(lambda s: pack_bits(requests.counts[s] > 1))

    def finish(table: pa.Table, replies: list[pa.Table]) -> pa.Table:
        chunk = _Chunk(table, window, n_buckets, replies[0])
        return keep(table, chunk.runs, chunk.repeated(*replies[1:]))

    judged = ex.ask(rows.groupBy("chunk").applyInArrow(probe, ex.REQUESTS), lambda t: _judge(t, hot))
    shared = ex.with_answers(rows, [judged], contexts, CONTEXTS).groupBy("bucket").applyInArrow(
        lambda t: _sort_contexts(t, window), ex.REPLIES)
    counted = ex.ask(ex.with_answers(rows, [judged], hashes, ex.REQUESTS), _twice)
    return ex.with_answers(rows, [judged, shared, counted], finish, schema)


def suffix_digests(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW,
                   hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and the SHA-256 of what stays."""

    def keep(table: pa.Table, runs: _Runs, removed: np.ndarray) -> pa.Table:
        edges = runs.offsets.tolist()
        sums = np.concatenate([[0], np.cumsum(removed)])
        begins = removed.copy()
        inner = np.ones(len(removed), dtype=bool)
        inner[runs.offsets[:-1][runs.offsets[:-1] < len(removed)]] = False
        begins[1:] &= ~(removed[:-1] & inner[1:])
        spans = np.concatenate([[0], np.cumsum(begins)])
        stays = [sha256(runs.data[a:b][~removed[a:b]].tobytes()).hexdigest() for a, b in zip(edges[:-1], edges[1:], strict=True)]
        return pa.table({
            "doc_id": table["id"],
            "n_bytes": pa.array(np.diff(runs.offsets), pa.int64()),
            "n_removed": pa.array(np.diff(sums[runs.offsets]), pa.int64()),
            "n_spans": pa.array(np.diff(spans[runs.offsets]), pa.int64()),
            "kept_sha256": pa.array(stays, pa.string()),
        })

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return _with_kept(rows, "text", "doc_id", window, hot, keep,
                      "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


def repeated_spans(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW,
                   hot: int = HOT) -> DataFrame:
    """doc_id and the spans [start, end) of bytes that go, as an array of structs in order."""

    def keep(table: pa.Table, runs: _Runs, removed: np.ndarray) -> pa.Table:
        found = []
        for a, b in zip(runs.offsets[:-1].tolist(), runs.offsets[1:].tolist(), strict=True):
            edges = np.flatnonzero(np.diff(removed[a:b].astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
            found.append([{"start": int(s), "end": int(e)} for s, e in edges])
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table({"doc_id": table["id"], "spans": pa.array(found, kind)})

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return _with_kept(rows, "text", "doc_id", window, hot, keep,
                      "doc_id bigint, spans array<struct<start: bigint, end: bigint>>")
