"""Shards as ranges of hashes, which can be split where they are hot.

A log has a position: 31 bits of its source's hash, then 31 of its id's. Shards are ranges of positions, so the logs
of a source stay together, and only a source too large for a shard is cut, by its ids. A split closes a shard
and gives its range to children with new numbers. Nothing stored moves: cursors of a closed shard stay
valid, and a reader goes on there for what was put before, or by a put that began before, and in the children for the rest.

The list of shards is small and held by the caller, like the ranges of a pull; logs are counted and cut by Spark.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import astuple, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.functions.cursors import FIRST
from logloom.model import Shard, ShardRange

_BITS = 31
SPACE = 1 << (2 * _BITS)
#: Positions are looked up by their first 12 bits.
_SLICE = 2 * _BITS - 12
#: Bounds the table that goes to all tasks: a row per shard, and at most 4,096 more.
MAX_OPEN = 10_000
_SHARDS = "shard int, low bigint, high bigint, parent int, closed_at bigint"


def even_shards(n: int) -> list[Shard]:
    """`n` ranges of one size."""
    if n < 1:
        raise ValueError("a store has at least one shard")
    edges = [SPACE * i // n for i in range(n + 1)]
    return [Shard(i, edges[i], edges[i + 1]) for i in range(n)]


def open_shards(shards: Sequence[Shard]) -> list[Shard]:
    """Shards that take puts, in the order of their ranges, which have to cover all positions once."""
    taken = sorted((s for s in shards if s.closed_at is None), key=lambda s: s.low)
    edges = [0, *(s.high for s in taken)]
    if [s.low for s in taken] != edges[:-1] or edges[-1] != SPACE or any(s.low >= s.high for s in taken):
        raise ValueError("open shards leave positions out, or overlap")
    if len({s.shard for s in shards}) < len(shards):
        raise ValueError("two shards have one number")
    if len(taken) > MAX_OPEN:
        raise ValueError(f"more than {MAX_OPEN} open shards")
    return taken


def hash_position(key: str = "source", log_id: str = "log_id") -> Column:
    """Position of a log; NULL counts as the empty string."""
    def part(name: str) -> Column:
        digest = F.md5(F.coalesce(F.col(name).cast("string"), F.lit("")))
        return F.shiftright(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), 1)

    return F.shiftleft(part(key), _BITS).bitwiseOR(part(log_id))


def _placed(logs: DataFrame, shards: Sequence[Shard], key: str, log_id: str) -> DataFrame:
    """Logs with their `_position` and open shard."""
    rows = [(k, s.low, s.high, s.shard) for s in open_shards(shards) for k in range(s.low >> _SLICE, ((s.high - 1) >> _SLICE) + 1)]
    slices = logs.sparkSession.createDataFrame(rows, "_slice bigint, _low bigint, _high bigint, shard int")
    at = F.col("_position")
    inside = (F.shiftright(at, _SLICE) == F.col("_slice")) & (at >= F.col("_low")) & (at < F.col("_high"))
    placed = logs.drop("shard").withColumn("_position", hash_position(key, log_id))
    return placed.join(F.broadcast(slices), inside).drop("_slice", "_low", "_high")


def assign_shard_by_range(logs: DataFrame, shards: Sequence[Shard], key: str = "source", log_id: str = "log_id") -> DataFrame:
    """Add the shard that takes each log, replacing a column `shard`. No shuffle."""
    return _placed(logs, shards, key, log_id).drop("_position")


def split_shards(logs: DataFrame, shards: Sequence[Shard], max_share: float, at: int, key: str = "source",
                 log_id: str = "log_id", accuracy: int = 10_000) -> list[Shard]:
    """Split every open shard that takes more than `max_share` of some logs, such as the last day's, at time `at`.

    A shard is cut into as few children as bring each to that share, at quantiles of its positions; they are within
    1 / `accuracy` of their rank. Both passes aggregate before they shuffle, and leave a row per shard and one row.
    Logs of one source and one id have one position and stay together. Without logs nothing is split.
    """
    if not 0 < max_share <= 1:
        raise ValueError("a share lies above 0 and at most at 1")
    placed = _placed(logs.select(key, log_id), shards, key, log_id).select("shard", "_position")
    counts = {r["shard"]: r["count"] for r in placed.groupBy("shard").count().collect()}
    most = max_share * sum(counts.values())
    parts = {s: math.ceil(n / most) for s, n in counts.items() if n > most}
    if not parts:
        return list(shards)
    cut = placed.filter(F.col("shard").isin(*parts)).agg(*[
        F.percentile_approx(F.when(F.col("shard") == s, F.col("_position")), [i / k for i in range(1, k)], accuracy).alias(str(s))
        for s, k in parts.items()]).first()
    result, number = [], max(s.shard for s in shards) + 1
    for shard in shards:
        inner = sorted({c + 1 for c in cut[str(shard.shard)]} - {shard.high}) if shard.shard in parts else []
        if not inner:
            result.append(shard)
            continue
        result.append(replace(shard, closed_at=at))
        for low, high in zip([shard.low, *inner], [*inner, shard.high], strict=True):
            result.append(Shard(number, low, high, shard.shard))
            number += 1
    open_shards(result)
    return result


def follow_ranges(shards: Sequence[Shard], cursors: Mapping[int, str]) -> list[ShardRange]:
    """Where a reader goes on in all shards: behind its cursors, and at the begin of shards that are new to it. Parents come
    before their children. Closed shards stay in, for puts that were under way when they were split."""
    return [ShardRange(s.shard, cursors.get(s.shard, FIRST)) for s in sorted(shards, key=lambda s: s.shard)]


def shards_frame(spark: SparkSession, shards: Sequence[Shard]) -> DataFrame:
    """The list as rows, to be stored beside the logs."""
    return spark.createDataFrame([astuple(s) for s in shards], _SHARDS)


def shards_of(rows: DataFrame) -> list[Shard]:
    """The list from its rows, all of them: a list that a caller has held before."""
    return [Shard(*r) for r in rows.select("shard", "low", "high", "parent", "closed_at").orderBy("shard").collect()]
