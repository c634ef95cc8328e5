"""Sharding, packing into groups, checking, retention and volume of logs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from logloom.functions.cursors import make_cursor
from logloom.functions.sizes import group_size
from logloom.functions.times import floor_to, utc_date, utc_day
from logloom.model import MAX_TIME
from logloom.plans.skew import DEFAULT_HEAT, Heat, heavy_keys, is_heavy

_DAY = 86_400
_GROUP_KEY = ["shard", "topic", "source", "reserved", "date", "window"]


def assign_shard(logs: DataFrame, n: int, key: str = "source") -> DataFrame:
    """Add a stable shard id in [0, n) from a column; a changed `n` affects new data only."""
    digest = F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))), 1, 8)
    return logs.withColumn("shard", F.pmod(F.conv(digest, 16, 10).cast("bigint"), F.lit(n)).cast("int"))


def pack_log_groups(logs: DataFrame, max_logs: int, window_s: int, arrival: int | Column | None = None,
                    heat: Heat = DEFAULT_HEAT) -> DataFrame:
    """Nest logs of one shard, topic, source, day and time window into groups of at most `max_logs`.

    Groups fill up in the order of time, then of a hash of the log id; log ids must be unique. With an
    `arrival`, a UNIX time or a column over the groups such as `max_time`, they get their cursors here;
    otherwise `put_logs` gives them.

    A window's logs meet in one task after one shuffle. Those of a window that holds an outsized share of
    all logs are spread by second and hash; counts per second and hash tell where each such slot starts,
    and the logs move once more, to their groups. Either way the groups are the same.
    """
    identity = F.md5(F.coalesce(F.col("log_id"), F.lit("")))
    keyed = logs.select(
        "log_id", "time", "topic", "source", "reserved", "contents", "shard",
        utc_date(F.col("time")).alias("date"),
        floor_to(F.col("time"), window_s).alias("window"),
        identity.alias("hash"),
    )
    heavy = F.broadcast(heavy_keys(keyed, _GROUP_KEY, heat))
    marked = keyed.join(heavy, is_heavy(_GROUP_KEY), "left").withColumn("hot", F.col("heavy_rows").isNotNull())
    marked = marked.select(*keyed.columns, "hot")
    rank = lambda *by: F.row_number().over(W.partitionBy(*by).orderBy("time", "hash", "log_id")) - 1
    light = marked.filter(~F.col("hot")).withColumn("position", rank(*_GROUP_KEY))

    # No more slots per window than its seconds times 256.
    slot = [*_GROUP_KEY, "time", "slice"]
    hot = marked.filter("hot").withColumn("slice", F.substring("hash", 1, 2))
    earlier = W.partitionBy(*_GROUP_KEY).orderBy("time", "slice").rowsBetween(W.unboundedPreceding, -1)
    starts = hot.groupBy(*slot).agg(F.count(F.lit(1)).alias("n")).withColumn(
        "start", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    same = reduce(Column.__and__, [F.col(f"l.{k}").eqNullSafe(F.col(f"s.{k}")) for k in slot])
    spread = (
        hot.withColumn("rank", rank(*slot)).alias("l").join(starts.alias("s"), same)
        .select("l.*", (F.col("s.start") + F.col("l.rank")).alias("position")).drop("slice", "rank")
    )
    packed = _packed(light, max_logs).unionByName(_packed(spread, max_logs))
    return describe_groups(packed, None if arrival is None else make_cursor(_column(arrival), _identity()))


def _packed(placed: DataFrame, max_logs: int) -> DataFrame:
    log = F.struct("time", "hash", "log_id", "contents")
    return (
        placed.groupBy(*_GROUP_KEY, F.floor(F.col("position") / max_logs).alias("chunk"))
        .agg(F.sort_array(F.collect_list(log)).alias("sorted"))
        .withColumn("first_id", F.col("sorted")[0]["log_id"])
        .withColumn("logs", F.transform(
            "sorted", lambda l: F.struct(l["time"].alias("time"), l["contents"].alias("contents"))))
        .drop("sorted", "chunk")
    )


def _column(arrival: int | Column) -> Column:
    return arrival if isinstance(arrival, Column) else F.lit(arrival)


def _identity() -> Column:
    """A value that no other packed group has: everything it is grouped by, and its first log. Texts go in
    as hashes, so that none can imitate a separator."""
    text = lambda c: F.coalesce(F.md5(c), F.lit("-"))
    return F.concat_ws("/", F.col("shard").cast("string"), text("topic"), text("source"), text("reserved"),
                       F.col("window").cast("string"), text("first_id"))


def first_second(logs: str = "logs") -> Column:
    """Smallest time in a group."""
    return F.array_min(F.transform(logs, lambda l: l["time"]))


def describe_groups(groups: DataFrame, cursor: Column | None, extra: Sequence[str] = ()) -> DataFrame:
    """Groups in stored form: cursor, time bounds, number of logs and encoded size from `logs`, and
    the columns `extra` as they are. The cursor may refer to all of these; there is none where it is None."""
    times = F.transform("logs", lambda l: l["time"])
    described = groups.withColumns({
        "min_time": F.array_min(times),
        "max_time": F.array_max(times),
        "n_logs": F.size("logs"),
        "raw_size": group_size("logs", "reserved", "topic", "source"),
        "date": utc_date(F.array_min(times)),
    })
    return described.select(
        *([] if cursor is None else [cursor.alias("cursor")]),
        "topic", "source", "reserved", "min_time", "max_time", "n_logs", "raw_size", "logs", "date", "shard", *extra,
    )


def split_days(groups: DataFrame) -> DataFrame:
    """Cut groups at UTC midnight, so that the day of a group is the day of all its logs."""
    day = lambda l: utc_date(l["time"])
    return (
        groups.withColumn("day", F.explode(F.array_distinct(F.transform("logs", day))))
        .withColumn("logs", F.filter("logs", lambda l: day(l) == F.col("day")))
        .drop("day")
    )


def flatten_log_groups(groups: DataFrame) -> DataFrame:
    """One row per log, in stored form; the id is the group's cursor and the place in the group."""
    return groups.select("*", F.posexplode("logs").alias("ordinal", "log")).select(
        F.concat_ws("-", "cursor", F.lpad(F.col("ordinal").cast("string"), 8, "0")).alias("log_id"),
        F.col("log.time").alias("time"),
        "topic", "source", "reserved",
        F.col("log.contents").alias("contents"),
        "cursor", "date", "shard",
    )


def flatten_contents(logs: DataFrame) -> DataFrame:
    """One row per key and value of a log, in their order."""
    return logs.select(
        "log_id", "time", "topic", "source", F.posexplode("contents").alias("position", "content")
    ).select("log_id", "time", "topic", "source", "position", "content.key", "content.value")


def invalid_reason(logs: str = "logs") -> Column:
    """Why a group cannot be stored; NULL for a valid one. Every log needs a time, every content a
    key and a value."""
    no_time = F.exists(logs, lambda l: l["time"].isNull())
    bad_time = F.exists(logs, lambda l: (l["time"] < 0) | (l["time"] > MAX_TIME))
    half_content = F.exists(logs, lambda l: F.coalesce(
        F.exists(l["contents"], lambda c: c["key"].isNull() | c["value"].isNull()), F.lit(False)))
    return (
        F.when(F.col(logs).isNull(), "group without logs")
        .when(no_time, "log without time")
        .when(bad_time, "time out of range")
        .when(half_content, "content without key or value")
    )


def check_groups(groups: DataFrame) -> DataFrame:
    """Groups with a `reject_reason` column. Empty groups are valid, hold nothing and are left out; a group
    whose logs are NULL is not an empty one."""
    kept = groups.filter(F.col("logs").isNull() | (F.size("logs") > 0))
    return kept.withColumn("reject_reason", invalid_reason())


def expire_logs(logs: DataFrame, store_ttl: int, as_of: int, index_ttl: int | None = None) -> DataFrame:
    """Logs still inside their retention in days; searchable logs are inside both retentions."""
    days = store_ttl if index_ttl is None else min(store_ttl, index_ttl)
    oldest = as_of - days * _DAY
    return logs.filter((F.col("date") >= utc_day(oldest)) & (F.col("time") >= oldest))


def meter_volume(groups: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    """Groups, logs and encoded bytes per topic, source, hour or whatever else `by` names."""
    return groups.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_groups"),
        F.sum(F.col("n_logs").cast("bigint")).alias("n_logs"),
        F.sum("raw_size").alias("bytes"),
    )
