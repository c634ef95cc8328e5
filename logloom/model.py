"""Schemas of the stored tables and the plain configuration objects.

A log is one record: UNIX seconds plus a list of key/value contents. Logs travel in groups that
share topic, source and a reserved field; groups live in shards and are read by cursor.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

CONTENT = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
])
CONTENTS = T.ArrayType(CONTENT)
LOG = T.StructType([
    T.StructField("time", T.LongType()),
    T.StructField("contents", CONTENTS),
])

LOGS_SCHEMA = T.StructType([
    T.StructField("log_id", T.StringType()),
    T.StructField("time", T.LongType()),
    T.StructField("topic", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("reserved", T.StringType()),
    T.StructField("contents", CONTENTS),
    T.StructField("cursor", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("shard", T.IntegerType()),
])

GROUPS_SCHEMA = T.StructType([
    T.StructField("cursor", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("reserved", T.StringType()),
    T.StructField("min_time", T.LongType()),
    T.StructField("max_time", T.LongType()),
    T.StructField("n_logs", T.IntegerType()),
    T.StructField("raw_size", T.LongType()),
    T.StructField("logs", T.ArrayType(LOG)),
    T.StructField("date", T.DateType()),
    T.StructField("shard", T.IntegerType()),
])

POSTINGS_SCHEMA = T.StructType([
    T.StructField("token", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("shard", T.IntegerType()),
    T.StructField("log_id", T.StringType()),
    T.StructField("bucket", T.IntegerType()),
])

KEY_POSTINGS_SCHEMA = T.StructType([
    T.StructField("token", T.StringType()),
    T.StructField("number", T.LongType()),
    T.StructField("real", T.DoubleType()),
    T.StructField("shard", T.IntegerType()),
    T.StructField("log_id", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("key", T.StringType()),
])

# The largest UNIX time a log may carry, the key types an index knows, the two named
# cursor positions, the topic modes that are not a path regex, and the mark of a finished result.
MAX_TIME = 4294967295
KEY_TYPES = ("text", "long", "double")
POSITION_BEGIN = "begin"
POSITION_END = "end"
TOPIC_NONE = "none"
TOPIC_DEFAULT = "default"
TOPIC_GROUP = "group_topic"
ID_TYPE_USERDEFINED = "userdefined"
COMPLETE = "Complete"


def _check_delimiters(token: tuple[str, ...]) -> None:
    if "" in token:
        raise ValueError("a delimiter has at least one character")


@dataclass(frozen=True)
class IndexKey:
    """How one key is searched: as tokens (`text`) or as a number (`long`, `double`)."""

    type: str = "text"
    token: tuple[str, ...] = ()
    case_sensitive: bool = False

    def __post_init__(self):
        if self.type not in KEY_TYPES:
            raise ValueError(f"index key type must be one of {KEY_TYPES}, got {self.type!r}")
        _check_delimiters(self.token)


@dataclass(frozen=True)
class IndexLine:
    """Token search over the values of all included keys (none included means all) minus the
    excluded ones."""

    token: tuple[str, ...] = ()
    case_sensitive: bool = False
    include_keys: tuple[str, ...] = ()
    exclude_keys: tuple[str, ...] = ()

    def __post_init__(self):
        _check_delimiters(self.token)


@dataclass(frozen=True)
class Index:
    """Index of a log store; `ttl` in days."""

    ttl: int
    keys: dict[str, IndexKey] = field(default_factory=dict)
    line: IndexLine | None = None


@dataclass(frozen=True)
class Shard:
    """A range [low, high) of hash positions; one that has been split is closed for puts, and has children."""

    shard: int
    low: int
    high: int
    parent: int | None = None
    closed_at: int | None = None


@dataclass(frozen=True)
class ShardRange:
    """Cursors of one shard to read between; no end means up to the head."""

    shard: int
    cursor: str
    end_cursor: str | None = None


@dataclass(frozen=True)
class CollectConfig:
    """Recipe that turns files below `log_path` into logs for one destination. `max_lines` refuses longer
    records; `line_sep` ends a line (`\\r\\n` for files of that kind)."""

    name: str
    log_path: str
    file_pattern: str = "*"
    log_begin_regex: str = ""
    regex: str = ""
    keys: tuple[str, ...] = ()
    time_key: str = ""
    time_format: str = ""
    filter_keys: tuple[str, ...] = ()
    filter_regex: tuple[str, ...] = ()
    topic_format: str = TOPIC_NONE
    project: str = ""
    logstore: str = ""
    max_lines: int | None = None
    line_sep: str = "\n"

    def __post_init__(self):
        if not self.name:
            raise ValueError("a config needs a name")
