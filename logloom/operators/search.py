"""Search: time range, topic and predicate; pages of hits and their histogram over time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions.fields import field_map
from logloom.functions.times import floor_to, utc_day
from logloom.model import COMPLETE
from logloom.operators.ingest import flatten_log_groups


#: Slices of time whose hits are counted at once, and hits in front of a page that are sorted and passed over.
SLICES, PASSED = 1024, 10_000


def scan_logs(logs: DataFrame, from_time: int, to_time: int, topic: str = "") -> DataFrame:
    """Logs of [from, to) and one topic; the empty topic means any.

    The implied range of days is added, because Spark does not derive from a filter on `time` which
    `date` partitions it can skip.
    """
    hits = logs
    if "date" in logs.columns:
        hits = hits.filter(F.col("date").between(utc_day(from_time), utc_day(to_time - 1)))
    hits = hits.filter((F.col("time") >= from_time) & (F.col("time") < to_time))
    return hits.filter(F.col("topic") == topic) if topic else hits


def scan_groups(groups: DataFrame, from_time: int, to_time: int, topic: str = "") -> DataFrame:
    """`scan_logs` on stored groups, flattened. Groups outside the range or topic are skipped by their
    own columns, which the scan of the store checks per file and row group before any log is read."""
    near = groups.filter(
        F.col("date").between(utc_day(from_time), utc_day(to_time - 1))
        & (F.col("max_time") >= from_time) & (F.col("min_time") < to_time)
    )
    if topic:
        near = near.filter(F.col("topic") == topic)
    return scan_logs(flatten_log_groups(near), from_time, to_time)


def find_logs(logs: DataFrame, from_time: int, to_time: int, topic: str = "",
              predicate: Column | None = None) -> DataFrame:
    """All hits of a search, unordered: the form to export or to aggregate."""
    hits = scan_logs(logs, from_time, to_time, topic)
    return hits if predicate is None else hits.filter(predicate)


def get_logs(logs: DataFrame, topic: str, from_time: int, to_time: int, predicate: Column | None = None,
             lines: int = 100, offset: int = 0, reverse: bool = False,
             after: tuple[int, str] | None = None) -> DataFrame:
    """One page of hits in the order of time and log id, or the reverse.

    Every task keeps its own first `offset + lines` rows, so a page costs more the deeper it lies, see
    `get_logs_by_rank`. `after`, the (time, log_id) of the last hit seen, continues at the same cost on every page.
    """
    hits = find_logs(logs, from_time, to_time, topic, predicate)
    time, log_id = F.col("time"), F.col("log_id")
    if after is not None:
        seen_time, seen_id = F.lit(after[0]), F.lit(after[1])
        if reverse:
            hits = hits.filter((time < seen_time) | ((time == seen_time) & (log_id < seen_id)))
        else:
            hits = hits.filter((time > seen_time) | ((time == seen_time) & (log_id > seen_id)))
    order = [time.desc(), log_id.desc()] if reverse else [time, log_id]
    page = hits.orderBy(*order).offset(offset).limit(lines)
    return page.select("log_id", "time", "topic", "source", field_map().alias("fields"))


def _rank_bounds(hits: DataFrame, from_time: int, to_time: int, lines: int, offset: int,
                 reverse: bool) -> tuple[int, int, int] | None:
    """Part of [from, to) that holds a page, and how many of its hits precede the page; None where it is empty."""
    begin, end, last = from_time, to_time, None
    while True:
        width = max(1, -(-(end - begin) // SLICES))
        inside = hits.filter((F.col("time") >= begin) & (F.col("time") < end))
        counts = sorted(inside.groupBy(F.floor((F.col("time") - begin) / width).alias("slice")).count().collect(), reverse=reverse)
        passed, first = 0, None
        for n, count in counts:
            if first is None and passed + count > offset:
                first, skip = n, offset - passed
            passed += count
            if last is None and passed >= offset + lines:
                last = begin + n * width if reverse else min(begin + (n + 1) * width, end)
        if first is None:
            return None
        if last is None:
            last = begin if reverse else end
        begin, end, offset = begin + first * width, min(begin + (first + 1) * width, end), skip
        if offset <= PASSED or width == 1:
            return (last, end, offset) if reverse else (begin, last, offset)


def get_logs_by_rank(logs: DataFrame, topic: str, from_time: int, to_time: int, predicate: Column | None = None,
                     lines: int = 100, offset: int = 0, reverse: bool = False) -> DataFrame:
    """The page `get_logs` gives, at a cost that does not grow with its depth.

    Hits are counted per slice of time, at most `SLICES` numbers, and the slice in which the page begins is sliced again
    until no more than `PASSED` hits of it precede the page or it is a second. Only from there to the slice in
    which the page ends are hits sorted. The counts are jobs that run at once, on the columns of the search alone;
    the logs must not change between them and the page. Hits of one second are not told apart by counts.
    """
    hits = find_logs(logs, from_time, to_time, topic, predicate)
    bounds = _rank_bounds(hits, from_time, to_time, lines, offset, reverse) if lines > 0 and from_time < to_time else None
    if bounds is None:
        return get_logs(logs, topic, from_time, to_time, predicate, lines=0, reverse=reverse)
    begin, end, skip = bounds
    return get_logs(logs, topic, begin, end, predicate, lines, skip, reverse)


def get_histograms(logs: DataFrame, topic: str, from_time: int, to_time: int,
                   predicate: Column | None = None, bucket_seconds: int = 3600) -> DataFrame:
    """Hits per bucket of [from, to), empty buckets included; the last bucket ends at `to`.

    Empty buckets come from a generated range whose zeros are added up with the hits, which needs
    no join. A batch result is complete by construction.
    """
    hits = find_logs(logs, from_time, to_time, topic, predicate)
    start = floor_to(F.col("time"), bucket_seconds, from_time)
    counted = hits.select(start.alias("from"), F.lit(1).cast("bigint").alias("hit"))
    empty = logs.sparkSession.range(from_time, to_time, bucket_seconds).select(
        F.col("id").alias("from"), F.lit(0).cast("bigint").alias("hit")
    )
    return counted.unionByName(empty).groupBy("from").agg(F.sum("hit").alias("count")).select(
        "from",
        F.least(F.col("from") + bucket_seconds, F.lit(to_time)).cast("bigint").alias("to"),
        "count",
        F.lit(COMPLETE).alias("progress"),
    )


def histogram_total(histogram: DataFrame) -> DataFrame:
    """The count of a whole histogram: one row."""
    complete = F.min(F.when(F.col("progress") == COMPLETE, 1).otherwise(0)) == 1
    return histogram.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("count"),
        F.when(complete, COMPLETE).otherwise("Incomplete").alias("progress"),
    )
