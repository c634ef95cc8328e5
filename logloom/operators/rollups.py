"""Histograms from counts per topic and minute that are kept beside the logs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.functions.times import floor_to, utc_date, utc_day
from logloom.model import COMPLETE
from logloom.operators.ingest import flatten_log_groups

#: Seconds a count stands for.
WIDTH = 60
#: So many stretches of logs are named to the scan one by one; more are told by arithmetic.
NAMED = 64

_COUNTS = "topic string, minute bigint, count bigint, date date"


def build_rollup(groups: DataFrame) -> DataFrame:
    """(topic, minute, count, date) of the logs of groups, `minute` in UNIX seconds. Of the logs only their times are
    read, and counts are added up before they are shuffled."""
    times = groups.select("topic", F.explode("logs.time").alias("time"))
    minute = floor_to(F.col("time"), WIDTH).alias("minute")
    counts = times.groupBy("topic", minute).agg(F.count(F.lit(1)).alias("count"))
    return counts.withColumn("date", utc_date(F.col("minute")))


def write_rollup(groups: DataFrame, path: str, name: str) -> None:
    """Keep the counts of one put below `path`, in a folder of its `name`. Written again under the same name they
    replace what a failed attempt has left, so nothing counts twice; puts of different names add up."""
    build_rollup(groups).write.mode("overwrite").partitionBy("date").parquet(f"{path}/put={name}")


def read_rollup(spark: SparkSession, path: str) -> DataFrame:
    """The counts of all puts, for `rollup_histograms` or `merge_rollup`."""
    return spark.read.schema(f"{_COUNTS}, put string").parquet(path).drop("put")


def merge_rollup(counts: DataFrame) -> DataFrame:
    """One count per topic and minute, of any number of puts."""
    return counts.groupBy("date", "topic", "minute").agg(F.sum("count").alias("count")).select("topic", "minute", "count", "date")


def _edges(from_time: int, to_time: int, bucket_seconds: int) -> list[tuple[int, int]]:
    """Minutes, within [from, to), that a border of a bucket cuts."""
    borders = {to_time, *range(from_time, to_time, bucket_seconds)}
    minutes = sorted({b - b % WIDTH for b in borders if b % WIDTH})
    return [(max(m, from_time), min(m + WIDTH, to_time)) for m in minutes]


def _within(first: Column, last: Column, ranges: Sequence[tuple[int, int]]) -> Column:
    """Whether a stretch of time, ends included, meets one of the ranges."""
    return reduce(Column.__or__, [(last >= a) & (first < b) for a, b in ranges], F.lit(False))


def rollup_histograms(counts: DataFrame, groups: DataFrame, topic: str, from_time: int, to_time: int,
                      bucket_seconds: int = 3600) -> DataFrame:
    """`get_histograms` without a predicate, from counts (`read_rollup`) and the groups they were made of.

    Whole minutes of one bucket come from the counts. Logs are read only of the minutes that a border of a bucket cuts:
    at most two where buckets begin at whole minutes, and then only groups that reach into these.
    """
    days = F.col("date").between(utc_day(from_time), utc_day(to_time - 1))
    own = (lambda df: df.filter(F.col("topic") == topic)) if topic else (lambda df: df)
    bucket = lambda time: floor_to(time, bucket_seconds, from_time)
    minute = F.col("minute")
    last = minute + WIDTH - 1
    whole = (minute >= from_time) & (last < to_time) & (bucket(minute) == bucket(last))
    parts = [own(counts.filter(days & whole)).select(bucket(minute).alias("from"), "count")]
    aligned = from_time % WIDTH == 0 and bucket_seconds % WIDTH == 0
    if aligned:
        edges = _edges(to_time - to_time % WIDTH, to_time, WIDTH) if to_time % WIDTH else []
        edges = [(max(a, from_time), b) for a, b in edges]
    elif (to_time - from_time) // bucket_seconds < NAMED:
        edges = _edges(from_time, to_time, bucket_seconds)
    else:
        edges = [(from_time, to_time)]
    if edges and from_time < to_time:
        near = own(groups.filter(days & _within(F.col("min_time"), F.col("max_time"), edges)))
        time = F.col("time")
        logs = flatten_log_groups(near).filter(_within(time, time, edges) & (time >= from_time) & (time < to_time))
        start = floor_to(time, WIDTH)
        end = start + WIDTH - 1
        cut = (start < from_time) | (end >= to_time) | (bucket(start) != bucket(end))
        parts.append(logs.filter(cut).select(bucket(time).alias("from"), F.lit(1).cast("bigint").alias("count")))
    parts.append(counts.sparkSession.range(from_time, to_time, bucket_seconds).select(
        F.col("id").alias("from"), F.lit(0).cast("bigint").alias("count")))
    return reduce(DataFrame.unionByName, parts).groupBy("from").agg(F.sum("count").alias("count")).select(
        "from", F.least(F.col("from") + bucket_seconds, F.lit(to_time)).cast("bigint").alias("to"), "count",
        F.lit(COMPLETE).alias("progress"))
