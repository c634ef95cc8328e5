"""Files that still grow, and are rotated, as a stream of their lines.

A stream source whose offset is a byte position per file: where the last whole line ended. Each step reads from there
to the end of the last whole line; a half written line waits. A file is recognised by the digest of its first bytes,
not by its name: after `app.log` has become `app.log.1` its rest is read there, once, and what is `app.log` now is
another file and read from its begin, as is one that was emptied and written anew. Two files of one folder that
begin with the same kilobyte can't be told apart once one takes the other's name; a log that starts each line with a
time has no such twins.

The driver lists the files and reads their first kilobyte and their ends, the tasks read the lines, in splits; a split
ends with the line that its last byte lies in. Offsets are in the checkpoint of the query, so a step that is
repeated reads the same bytes, wherever rotation has taken them meanwhile; a file has to stay until its step is
done. Paths go through Arrow's file systems: local ones, that all machines mount, and object stores.
"""

from __future__ import annotations

import fnmatch
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SCHEMA = "file_path string, position bigint, next_position bigint, line string"
#: First bytes that tell files apart, bytes of a split, bytes read at once in search of a line's end, and lines in a batch.
PREFIX, SPLIT, STEP, LINES = 1024, 16 << 20, 1 << 16, 1 << 14
#: Listings until two in a row agree, so that a file that is being renamed is seen under one of its names.
_LISTINGS = 20

Entry = dict[str, int | str]


@dataclass
class Split(InputPartition):
    """Lines of a file that start in [begin, end)."""

    path: str
    prefix: int
    digest: str
    begin: int
    end: int
    first: int
    last: int


class Folder:
    """The log files below a path."""

    def __init__(self, path: str, pattern: str):
        self.fs, self.root = arrow_fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (
            arrow_fs.LocalFileSystem(), path)
        self.pattern = pattern

    def sizes(self, below: str | None = None) -> dict[str, int]:
        found = self.fs.get_file_info(arrow_fs.FileSelector(below or self.root, recursive=True, allow_not_found=True))
        return {f.path: f.size for f in found if f.is_file and f.base_name[0] not in "._" and fnmatch.fnmatchcase(f.base_name, self.pattern)}

    def read(self, path: str, begin: int, end: int) -> bytes:
        with self.fs.open_input_file(path) as file:
            file.seek(begin)
            return file.read(end - begin)

    def digest(self, path: str, prefix: int) -> str | None:
        """Digest of the first bytes; None where there are fewer, or no such file."""
        try:
            held = self.read(path, 0, prefix)
        except (FileNotFoundError, OSError):
            return None
        return blake2b(held, digest_size=16).hexdigest() if len(held) == prefix else None

    def whole_lines(self, path: str, size: int) -> int:
        """Where the last whole line ends."""
        end = size
        while end > 0:
            begin = max(0, end - STEP)
            at = self.read(path, begin, end).rfind(b"\n")
            if at >= 0:
                return begin + at + 1
            end = begin
        return 0

    def snapshot(self) -> dict[str, Entry]:
        """Position and identity of every file that has a whole line."""
        for _ in range(_LISTINGS):
            sizes, found = self.sizes(), {}
            try:
                for path, size in sizes.items():
                    if position := self.whole_lines(path, size):
                        prefix = min(position, PREFIX)
                        found[path] = {"position": position, "prefix": prefix, "digest": self.digest(path, prefix)}
            except FileNotFoundError:
                continue
            if self.sizes().keys() == sizes.keys() and all(e["digest"] for e in found.values()):
                return found
        raise TimeoutError(f"the files below {self.root} are renamed faster than they can be listed")

    def locate(self, path: str, prefix: int, digest: str) -> str:
        """Where a file is now."""
        if self.digest(path, prefix) == digest:
            return path
        for other in self.sizes(path.rpartition("/")[0]):
            if self.digest(other, prefix) == digest:
                return other
        raise FileNotFoundError(f"{path} is gone before its lines were read")

    def began(self, path: str, entry: Entry, before: dict[str, Entry]) -> int:
        """Position up to which an earlier snapshot has a file, under this name or another of the folder."""
        folder = path.rpartition("/")[0]
        same_name = [path] if path in before else []
        try:
            held = self.read(self.locate(path, entry["prefix"], entry["digest"]), 0, PREFIX)
        except FileNotFoundError:
            # Spark plans its last step again when a query starts, though it is done. Were it to be read, that would fail.
            known = before.get(path, {"position": 0})["position"]
            return known if known <= entry["position"] else 0
        for name in [*same_name, *(p for p in before if p != path and p.rpartition("/")[0] == folder)]:
            known = before[name]
            if known["position"] <= entry["position"] and len(held) >= known["prefix"] and \
                    blake2b(held[: known["prefix"]], digest_size=16).hexdigest() == known["digest"]:
                return known["position"]
        return 0

    def line_start(self, path: str, at: int, last: int) -> int:
        """Start of the first line at or behind a place."""
        begin = at - 1
        while begin < last:
            held = self.read(path, begin, min(last, begin + STEP))
            if (found := held.find(b"\n")) >= 0:
                return begin + found + 1
            begin += len(held)
        return last


class _Reader(DataSourceStreamReader):
    def __init__(self, path: str, pattern: str, split: int):
        self.path, self.pattern, self.split = path, pattern, split

    def initialOffset(self) -> dict:
        return {"files": {}}

    def latestOffset(self) -> dict:
        return {"files": Folder(self.path, self.pattern).snapshot()}

    def partitions(self, start: dict, end: dict) -> list[Split]:
        folder, splits = Folder(self.path, self.pattern), []
        for path, entry in end["files"].items():
            first, last = folder.began(path, entry, start["files"]), entry["position"]
            splits += [Split(path, entry["prefix"], entry["digest"], at, min(at + self.split, last), first, last)
                       for at in range(first, last, self.split)]
        return splits

    def read(self, partition: Split) -> Iterator[pa.RecordBatch]:
        folder = Folder(self.path, self.pattern)
        path = folder.locate(partition.path, partition.prefix, partition.digest)
        begin = partition.begin if partition.begin == partition.first else folder.line_start(path, partition.begin, partition.last)
        end = partition.end if partition.end == partition.last else folder.line_start(path, partition.end, partition.last)
        if begin < end:
            data = folder.read(path, begin, end)
            ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 10)
            starts = np.concatenate([[0], ends[:-1] + 1])
            for at in range(0, len(ends), LINES):
                first, behind = starts[at: at + LINES], ends[at: at + LINES]
                lines = [data[a:b].decode(errors="replace") for a, b in zip(first.tolist(), behind.tolist(), strict=True)]
                yield pa.record_batch({
                    "file_path": pa.array([partition.path] * len(lines), pa.string()),
                    "position": pa.array(begin + first, pa.int64()),
                    "next_position": pa.array(begin + behind + 1, pa.int64()), "line": pa.array(lines, pa.string())})


class GrowingFiles(DataSource):
    """Options: `path`, `pattern` of the names, `splitBytes`."""

    @classmethod
    def name(cls) -> str:
        return "growing_files"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> _Reader:
        return _Reader(self.options["path"], self.options.get("pattern", "*"), int(self.options.get("splitBytes", SPLIT)))


def follow_log_files(spark: SparkSession, path: str, pattern: str = "*", split_bytes: int = SPLIT) -> DataFrame:
    """Stream of the lines (file_path, position, next_position, line) of files below `path` while they grow. `file_path` is
    the name a file had when its step began, `position` the byte at which the line starts and `next_position` the one at
    which the next line does; both order the lines of a file."""
    spark.dataSource.register(GrowingFiles)
    return spark.readStream.format("growing_files").option("path", path).option("pattern", pattern).option(
        "splitBytes", split_bytes).load()
