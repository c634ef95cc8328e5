"""URL filters: rules and block lists of hosts and paths, probed in a sorted array of digests.

An entry is a host and a begin of a path, such as `example.org/en/`. It fits the host and all its subdomains,
where the URL's path begins so. Of several that fit the longest wins, of equally long ones that of the longer host.

1. Entries become 64-bit XXH64 digests, sorted by Spark and written to the shared folder in pieces: a file with
   the digests, one with the ends of the full strings and one with the strings. The pieces split the range of digests.
2. SQL functions cut every URL into host and path and list the keys an entry that fits it could have: each ending
   of the host at a label, with each begin of the path, of lengths that some entry has. They hash these keys.
3. Tasks map the digest files into memory, find all keys of a batch by binary search at once, and hold each hit's
   full string against the entry's, so that equal digests of different strings decide nothing. Executors fetch the
   files themselves, a lost one's successor again; what is mapped is shared by the workers of a machine, and
   pages no key falls into are never loaded.

The list is as long as it is: the driver writes one piece after the other, and neither driver nor tasks
hold more than a piece or a batch. The URLs are read once and never shuffled.

The host is what follows the first `://` up to `/`, `?`, `#` or the end, with A-Z as a-z; the path goes on from there
up to `?`, `#` or the end. A NULL URL, or one without `://`, has neither, and no entry fits it. Repeated rows are
judged alike. Entries without a host or with another verdict are ignored, A-Z of hosts count as a-z, and of equal
rules an allowing one wins. Rules come before the block list, whose entries block what no rule fits. An empty
table, or list, is no exception. Columns of the input stay; those with the names of added ones are replaced.
"""

from __future__ import annotations

import mmap
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.llm.tables import pieces, stored
from logloom.plans.scratch import scratch_path

ALLOW, BLOCK = "allow", "block"
#: Entries of a piece, whose digests take eight bytes each.
PIECE = 1 << 20
#: What the judging adds.
ADDED = ("host", "path", "rule", "listed", "verdict")

# Kinds of entries, in the order in which those of one key win.
_ALLOWING, _BLOCKING, _LISTED = "a", "b", "c"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lowered(host: Column) -> Column:
    return F.translate(host, _UPPER, _LOWER)


def with_host_and_path(urls: DataFrame, url: str = "url") -> DataFrame:
    """URLs with `host` and `path`."""
    whole = F.coalesce(F.col(url).cast("string"), F.lit(""))
    part = lambda n: F.regexp_extract(whole, r"(?s)^.*?://([^/?#]*)([^?#]*)", n)
    return urls.drop("host", "path").withColumns({"host": _lowered(part(1)), "path": part(2)})


def as_entries(spark: SparkSession, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """(host, path, verdict) from pairs of an entry such as `example.org/en/` and a verdict."""
    rows = [(*entry.partition("/")[::2], verdict) for entry, verdict in rules]
    return spark.createDataFrame(rows, "host string, path string, verdict string").withColumn("path", F.concat(F.lit("/"), "path"))


@dataclass(frozen=True)
class Piece:
    """One file set: its name, number of entries, least digest."""

    name: str
    n: int
    first: int


class Reader:
    """A piece, mapped into memory."""

    def __init__(self, piece: Piece):
        held = lambda kind: _mapped(SparkFiles.get(f"{piece.name}.{kind}"))
        self.digests = np.frombuffer(held("digests"), "<u8")
        self.ends = np.frombuffer(held("ends"), "<u8")
        self.strings = held("strings")

    def find(self, digests: np.ndarray, key: Callable[[int], bytes]) -> Iterator[tuple[int, bytes, bytes]]:
        """(number of a key, kind and string of an entry it equals); `key(n)` is the full string of a key."""
        at = np.searchsorted(self.digests, digests)
        hits = np.flatnonzero(self.digests[np.minimum(at, len(self.digests) - 1)] == digests)
        for n, place in zip(hits.tolist(), at[hits].tolist(), strict=True):
            # Equal digests, of different strings or kinds, lie side by side.
            while place < len(self.digests) and self.digests[place] == digests[n]:
                begin, end = int(self.ends[place - 1]) if place else 0, int(self.ends[place])
                if self.strings[begin + 1: end] == key(n):
                    yield n, self.strings[begin: begin + 1], self.strings[begin + 1: end]
                place += 1


def _mapped(path: str):
    with open(path, "rb") as file:
        return mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)


class DigestList:
    """Entries (host, path, kind: one letter) on the shared folder, known to all executors."""

    def __init__(self, entries: DataFrame, piece: int = PIECE):
        host, path = _lowered(F.col("host")), F.coalesce(F.col("path"), F.lit(""))
        known = entries.select(host.alias("host"), path.alias("path"), "kind").distinct()
        # What holds a slash where none can be, fits no URL; without those a key has one host and one path.
        known = known.filter((F.col("host") != "") & ~F.col("host").rlike("[/?#]") & (F.col("path").startswith("/") | (F.col("path") == "")))
        known = known.select(
            F.concat("host", "path").cast("binary").alias("key"), F.octet_length("host").alias("host_bytes"),
            F.octet_length("path").alias("path_bytes"), "kind")
        known = stored(known.withColumn("digest", F.xxhash64("key")), "entries")
        self.spark = known.sparkSession
        lengths = lambda c: sorted(r[0] for r in known.select(c).distinct().collect())
        #: Lengths that occur: as many as a host or path has bytes, however many entries there are.
        self.host_lengths, self.path_lengths = lengths("host_bytes"), lengths("path_bytes")
        n = known.count()
        self.pieces: list[Piece] = []
        # The order of signed numbers, which SQL has, differs from that of the digests' bits.
        unsigned = F.col("digest").bitwiseXOR(F.lit(-(1 << 63)))
        record = F.concat(F.col("kind").cast("binary"), "key")
        rows = known.select(unsigned.alias("order"), "digest", record.alias("record"))
        n_pieces = pieces(n, piece)
        parts = rows.repartitionByRange(n_pieces, "order") if n_pieces > 1 else rows.coalesce(1)
        parts = stored(parts.sortWithinPartitions("order", "record").withColumn("part", F.spark_partition_id()), "sorted")
        self.name, self.root = f"urls-{uuid.uuid4().hex}", scratch_path(self.spark, "digests")
        for part in sorted(r[0] for r in parts.select("part").distinct().collect()):
            self._write(parts.filter(F.col("part") == part).orderBy("order", "record").toArrow())

    def _write(self, table: pa.Table) -> None:
        digests = table["digest"].to_numpy().view(np.uint64)
        records = table["record"].to_pylist()
        name = f"{self.name}-{len(self.pieces)}"
        ends = np.cumsum([len(r) for r in records]).astype("<u8")
        for kind, data in (("digests", digests.astype("<u8").tobytes()), ("ends", ends.tobytes()), ("strings", b"".join(records))):
            path = f"{self.root}/{name}.{kind}"
            _put(self.spark, path, data)
            self.spark.sparkContext.addFile(path)
        self.pieces.append(Piece(name, len(records), int(digests[0])))


def _put(spark: SparkSession, path: str, data: bytes) -> None:
    """Write a file wherever Hadoop's file systems reach."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at)
    try:
        for first in range(0, len(data), 1 << 20):
            out.write(data[first: first + (1 << 20)])
    finally:
        out.close()


def _keys(host_lengths: list[int], path_lengths: list[int]) -> Column:
    """Every key of an entry that would fit (host, path): where it starts in the host's bytes, how much of the
    path it has, and its digest; the one that wins first."""
    n = F.octet_length("host")
    host, path = F.col("host").cast("binary"), F.col("path").cast("binary")
    starts = F.filter(F.transform(F.array(*[F.lit(k) for k in host_lengths]), lambda k: n - k), lambda s: (s == 0) | (
        (s > 0) & (F.substring(host, s, F.lit(1)) == F.lit(b"."))))
    lengths = F.filter(F.array(*[F.lit(k) for k in path_lengths]), lambda k: k <= F.octet_length("path"))
    key = lambda s, k: F.concat(F.substring(host, s + 1, n - s), F.substring(path, F.lit(1), k))
    every = F.flatten(F.transform(starts, lambda s: F.transform(lengths, lambda k: F.struct(
        (s - n - k).alias("order"), s.alias("start"), k.alias("length"), F.xxhash64(key(s, k)).alias("digest")))))
    return F.array_sort(every)


def judge_urls(urls: DataFrame, rules: DataFrame, blocked: DataFrame | None = None, url: str = "url",
               default: str = ALLOW, piece: int = PIECE) -> DataFrame:
    """Rows with `host`, `path`, `rule` (that wins, NULL if none fits), `listed` (the entry of the block list that
    does) and `verdict`: the rule's (host, path, verdict), else `block` where a listed entry (host, path) fits,
    else `default`."""
    kind = F.when(F.col("verdict") == ALLOW, _ALLOWING).when(F.col("verdict") == BLOCK, _BLOCKING)
    entries = rules.select("host", "path", kind.alias("kind")).filter("kind is not null")
    if blocked is not None:
        entries = entries.unionByName(blocked.select("host", "path", F.lit(_LISTED).alias("kind")))
    found = DigestList(entries, piece)
    kept = [c for c in urls.columns if c not in ADDED]
    rows = with_host_and_path(urls, url).select(*[F.col(f"`{c}`") for c in kept], "host", "path")
    if not found.pieces:
        nothing = F.lit(None).cast("string")
        return rows.withColumns({"rule": nothing, "listed": nothing, "verdict": F.lit(default)})
    rows = rows.withColumn("_keys", _keys(found.host_lengths, found.path_lengths))
    schema = T.StructType([*rows.drop("_keys").schema, *[T.StructField(c, T.StringType()) for c in ("rule", "listed", "verdict")]])
    known = found.pieces

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        readers: dict[int, Reader] = {}
        edges = np.array([p.first for p in known[1:]], dtype=np.uint64)
        for batch in batches:
            keys = batch.column("_keys")
            of = np.repeat(np.arange(batch.num_rows), np.diff(keys.offsets.to_numpy()))
            start, length, digest = (keys.flatten().field(c).to_numpy(zero_copy_only=False) for c in ("start", "length", "digest"))
            digest = digest.view(np.uint64)
            host, path = batch.column("host"), batch.column("path")

            def key(n: int, start=start, length=length, of=of, host=host, path=path) -> bytes:
                row = int(of[n])
                return host[row].as_py().encode()[start[n]:] + path[row].as_py().encode()[: length[n]]

            hits = []
            piece = np.searchsorted(edges, digest, side="right")
            for p in np.unique(piece).tolist():
                mine = np.flatnonzero(piece == p)
                readers[p] = readers.get(p) or Reader(known[p])
                hits += [(int(mine[n]), k, entry) for n, k, entry in
                         readers[p].find(digest[mine], lambda n, mine=mine, key=key: key(int(mine[n])))]
            rule, listed, verdict = ([x] * batch.num_rows for x in (None, None, default))
            # The first key of a row wins, and of its two kinds of rule the allowing one; a rule beats the list.
            for n, k, entry in sorted(hits, reverse=True):
                (listed if k == _LISTED.encode() else rule)[of[n]] = entry.decode()
                if k != _LISTED.encode():
                    verdict[of[n]] = ALLOW if k == _ALLOWING.encode() else BLOCK
            verdict = [BLOCK if b is not None and r is None else v for r, b, v in zip(rule, listed, verdict, strict=True)]
            columns = [batch.column(n) for n in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*columns, *[pa.array(c, pa.string()) for c in (rule, listed, verdict)]], names=schema.names)

    return rows.mapInArrow(probe, schema)
