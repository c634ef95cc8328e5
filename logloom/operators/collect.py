"""Raw lines to logs: multi-line records, regex fields, filters, time and topic."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from logloom.functions.fields import field
from logloom.functions.times import parse_seconds
from logloom.model import TOPIC_DEFAULT, TOPIC_GROUP, TOPIC_NONE
from logloom.plans.once import with_once

_BLOCK = ["file_path", "block_start"]
_PART = ["file_path", "record", "part"]
_SEPARATOR = "\x01"


def full_match(value: Column, regex: str) -> Column:
    """The whole value matches; the dot takes line breaks too."""
    return value.rlike(_whole(regex))


def _whole(regex: str) -> str:
    return rf"(?s)\A(?:{regex})\z"


def _block_summary(lines: DataFrame) -> DataFrame:
    """Per block of a file: its own shape, and what the blocks around it leave open.

    `lead` counts the lines before the first begin, `last_begin` is the id of the last one.
    `records_before` counts records begun before the block, `open_lines` the lines the last of them
    has so far, `next_lead` the lines the following block adds to the record open at the end.
    """
    first_begin = F.min(F.when(F.col("begins"), F.col("line_id")))
    blocks = lines.groupBy(*_BLOCK).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if("begins").alias("n_begins"),
        F.min("line_id").alias("first_id"),
        F.coalesce(first_begin - F.min("line_id"), F.count(F.lit(1))).alias("lead"),
        F.max(F.when(F.col("begins"), F.col("line_id"))).alias("last_begin"),
        F.max("line_id").alias("last_id"),
    )
    in_file = W.partitionBy("file_path").orderBy("block_start")
    earlier = in_file.rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.withColumn("lines_before", F.coalesce(F.sum("n_lines").over(earlier), F.lit(0)))
    # number of lines in the file before the last begin of the block
    begun_at = F.when(
        F.col("n_begins") > 0,
        F.col("lines_before") + F.col("n_lines") - (F.col("last_id") - F.col("last_begin") + 1),
    )
    return blocks.select(
        *_BLOCK, "n_begins", "first_id", "lead", "last_begin",
        F.coalesce(F.sum("n_begins").over(earlier), F.lit(0)).alias("records_before"),
        (F.col("lines_before") - F.coalesce(F.max(begun_at).over(earlier), F.lit(0))).alias("open_lines"),
        F.coalesce(F.lead("lead").over(in_file), F.lit(0)).alias("next_lead"),
    )


def _joined(lines: Column) -> Column:
    """Body of sorted (position, line) structs."""
    return F.array_join(F.transform(F.sort_array(F.collect_list(lines)), lambda l: l["line"]), "\n")


def assemble_records(lines: DataFrame, begin_regex: str, max_lines: int | None = None) -> DataFrame:
    """Multi-line records of files: (file_path, record, part, n_lines, body, oversize).

    A line that matches the begin regex as a whole starts record 1, 2, ... of its file; lines before
    the first one form record 0. No begin regex makes every line a record. Records are whole, part 0.
    Only with `max_lines` a longer record comes in parts 0, 1, ... of so many lines, all of them marked as
    `oversize`, so that no row is unbounded, no line is lost and nobody takes its head for the record.

    `lines` has file_path, block_start, line and line_id as `read_log_files` gives them; any other
    source does as long as line_id is stable and has no gaps inside a block. A first narrow pass
    leaves one row per block, which tells what crosses its borders. The text is shuffled once, by
    block; records inside a block are complete there, and only the lines of records that cross a
    border move again.
    """
    begins = F.col("line").rlike(_whole(begin_regex)) if begin_regex else F.lit(True)
    lines = lines.select(*_BLOCK, "line_id", "line")
    # The lines are shuffled by block anyway, so the summary only has to follow the same hash. Both
    # branches below read the same columns of this join, hence the same shuffle.
    summary = _block_summary(lines.withColumn("begins", begins))
    known = lines.join(summary.hint("shuffle_hash"), _BLOCK)

    def part(ordinal: Column) -> Column:
        return F.lit(0).cast("bigint") if max_lines is None else F.floor(ordinal / max_lines).cast("bigint")

    def oversize(n: Column) -> Column:
        return F.lit(False) if max_lines is None else n > max_lines

    place = F.col("line_id") - F.col("first_id")
    leads = place < F.col("lead")
    in_tail = F.coalesce(F.col("line_id") >= F.col("last_begin"), F.lit(False))
    from_before = leads & (F.col("open_lines") > 0)
    into_next = (in_tail | (leads & (F.col("n_begins") == 0))) & (F.col("next_lead") > 0)
    crosses = from_before | into_next

    in_block = W.partitionBy(*_BLOCK).orderBy("line_id").rowsBetween(W.unboundedPreceding, W.currentRow)
    own_begin = F.last(F.when(F.col("begins"), F.col("line_id")), ignorenulls=True).over(in_block)
    inner = (
        known.filter(~crosses)
        .withColumn("begins", begins)
        .select(
            *_BLOCK, "line_id", "line",
            (F.col("records_before") + F.sum(F.col("begins").cast("bigint")).over(in_block)).alias("record"),
            (F.col("line_id") - F.coalesce(own_begin, F.col("first_id"))).alias("ordinal"),
        )
    )
    if max_lines is not None:
        inner = inner.withColumn("last", F.max("ordinal").over(W.partitionBy(*_BLOCK, "record")))
    inner = (
        inner.groupBy(*_BLOCK, "record", part(F.col("ordinal")).alias("part"))
        .agg(F.count(F.lit(1)).alias("n_lines"), _joined(F.struct("line_id", "line")).alias("body"),
             *([] if max_lines is None else [F.max("last").alias("last")]))
        .select(*_PART, "n_lines", "body", oversize(F.col("last") + 1).alias("oversize"))
    )
    ordinal = F.when(leads, F.col("open_lines") + place).otherwise(F.col("line_id") - F.col("last_begin"))
    pieces = known.filter(crosses).select(
        "file_path", "block_start", "line_id", "line",
        (F.col("records_before") + F.when(leads, 0).otherwise(F.col("n_begins"))).alias("record"),
        part(ordinal).alias("part"),
    )
    crossing = pieces.groupBy(*_PART).agg(
        F.count(F.lit(1)).alias("n_lines"), _joined(F.struct("block_start", "line_id", "line")).alias("body"))
    if max_lines is None:
        crossing = crossing.withColumn("oversize", F.lit(False))
    else:
        # A record has a second part only if it is too long; these are few, and known without the text.
        long = pieces.filter(F.col("part") > 0).select("file_path", "record").distinct().withColumn("oversize", F.lit(True))
        crossing = crossing.join(long, ["file_path", "record"], "left").withColumn(
            "oversize", F.coalesce("oversize", F.lit(False)))
    return inner.unionByName(crossing.select(*inner.columns))


def _groups(body: Column, regex: str, n: int) -> Column:
    """Array of an empty string and the first `n` capture groups of a full match, of any other
    length where there is none.

    One replacement writes all groups, each behind a separator, so the regex runs once per record
    and not once per group. A body that itself holds the separator takes the slow way.
    """
    whole = _whole(regex)
    written = F.regexp_replace(body, whole, "".join(f"{_SEPARATOR}${g}" for g in range(1, n + 1)))
    one_by_one = F.when(
        body.rlike(whole), F.array(F.lit(""), *[F.regexp_extract(body, whole, g) for g in range(1, n + 1)])
    ).otherwise(F.array())
    return F.when(F.contains(body, F.lit(_SEPARATOR)), one_by_one).otherwise(F.split(written, _SEPARATOR))


def _count_groups(regex: str) -> int | None:
    """Number of capture groups, where Python reads the regex too."""
    try:
        return re.compile(regex).groups
    except re.error:
        return None


def extract_fields(records: DataFrame, regex: str, keys: Sequence[str], body: str = "body") -> DataFrame:
    """Add `contents` with one entry per key from the capture groups of a full match, and
    `reject_reason` where the body does not match (its contents are NULL). Without a regex the whole
    body is the value of the only key."""
    if not keys or (not regex and len(keys) != 1):
        raise ValueError("keys must name the capture groups, or the whole body where there is no regex")
    if regex and (n_groups := _count_groups(regex)) is not None and n_groups < len(keys):
        raise ValueError(f"{len(keys)} keys, but the regex has {n_groups} capture groups")
    groups = _groups(F.col(body), regex, len(keys)) if regex else F.array(F.lit(""), F.col(body))
    matched = F.coalesce(F.size("groups") == len(keys) + 1, F.lit(False))
    pairs = F.array(*[
        F.struct(F.lit(k).alias("key"), F.get("groups", F.lit(n)).alias("value")) for n, k in enumerate(keys, 1)
    ])
    return with_once(records, "groups", groups).withColumns({
        "contents": F.when(matched, pairs),
        "reject_reason": F.when(~matched, "extraction regex does not match"),
    }).drop("groups")


def keeps(filter_keys: Sequence[str], filter_regex: Sequence[str]) -> Column:
    """Every key's value satisfies its regex; pairs with an empty key are ignored."""
    if len(filter_keys) != len(filter_regex):
        raise ValueError("filter keys and filter regexes must have the same length")
    tests = [
        F.coalesce(full_match(field(k), r), F.lit(False)) for k, r in zip(filter_keys, filter_regex) if k
    ]
    return reduce(Column.__and__, tests, F.lit(True))


def filter_records(logs: DataFrame, filter_keys: Sequence[str], filter_regex: Sequence[str]) -> DataFrame:
    """Logs whose keys all satisfy their regexes; an absent key does not."""
    return logs.filter(keeps(filter_keys, filter_regex))


def parse_log_time(logs: DataFrame, time_key: str, time_format: str, ingest_time: int | None = None,
                   zone: str = "UTC") -> DataFrame:
    """Add `time` in UNIX seconds from one key, NULL where it does not parse. Without a format every
    log takes `ingest_time`."""
    if not time_format:
        if ingest_time is None:
            raise ValueError("without a time format an ingest time is needed")
        return logs.withColumn("time", F.lit(ingest_time).cast("bigint"))
    if not time_key:
        raise ValueError("a time format needs the key that holds the time")
    return with_once(logs, "time", parse_seconds(field(time_key), time_format, zone))


def topic_of(topic_format: str, path: str = "file_path", group_topic: str = "group_topic") -> Column:
    """Topic of a log: empty, the path, the machine group's topic, or the first group of a regex over the whole path
    (empty where it does not match)."""
    if topic_format in ("", TOPIC_NONE):
        return F.lit("")
    if topic_format == TOPIC_DEFAULT:
        return F.col(path)
    if topic_format == TOPIC_GROUP:
        return F.col(group_topic)
    return F.regexp_extract(path, _whole(topic_format), 1)


def derive_topic(logs: DataFrame, topic_format: str, path: str = "file_path",
                 group_topic: str = "group_topic") -> DataFrame:
    """Add `topic`, see `topic_of`."""
    return logs.withColumn("topic", topic_of(topic_format, path, group_topic))


def glob_regex(pattern: Column) -> Column:
    """A file name glob (`*` and `?`) as a regex; everything else is literal."""
    literal = F.regexp_replace(pattern, r"([\\.\[\]{}()+^$|])", r"\\$1")
    return F.replace(F.replace(literal, F.lit("*"), F.lit("[^/]*")), F.lit("?"), F.lit("[^/]"))
