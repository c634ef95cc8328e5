"""Reading shards by cursor: listing, positions and bounded pulls."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from logloom.functions.cursors import FIRST, after, cursor_at
from logloom.model import POSITION_BEGIN, POSITION_END, ShardRange

#: Groups of a pull up to which their places are sent to all tasks that read.
_FEW_GROUPS = 100_000


def _with_empty(shards: DataFrame, all_shards: int | None) -> DataFrame:
    """One row per shard, of empty ones too where the store's number of shards is given."""
    if all_shards is None:
        return shards
    ids = shards.sparkSession.range(all_shards).select(F.col("id").cast("int").alias("shard"))
    return ids.join(shards, "shard", "left")


def list_shards(groups: DataFrame, n_shards: int | None = None) -> DataFrame:
    """Shards with their number of groups, first and last cursor. With the store's number of shards,
    those that hold nothing yet are listed, too, without cursors."""
    held = groups.groupBy("shard").agg(
        F.count(F.lit(1)).alias("n_groups"),
        F.min("cursor").alias("first_cursor"),
        F.max("cursor").alias("last_cursor"),
    )
    return _with_empty(held, n_shards).withColumn("n_groups", F.coalesce("n_groups", F.lit(0).cast("bigint")))


def resolve_cursor(groups: DataFrame, positions: Sequence[str | int], n_shards: int | None = None) -> DataFrame:
    """Cursor of every position in every shard: `begin`, `end`, or the first group that arrived at or
    after a UNIX time.

    `end` lies right behind the last group, so it bounds what is there, and finds what comes next; a time
    after the last arrival is the smallest cursor of that time. All positions come from one partial
    aggregation.
    """
    wanted = list(dict.fromkeys(str(p) for p in positions))
    aggregates, otherwise = [], []
    for n, position in enumerate(wanted):
        if position == POSITION_BEGIN:
            found, default = F.min("cursor"), FIRST
        elif position == POSITION_END:
            found, default = after(F.max("cursor")), FIRST
        else:
            default = cursor_at(int(position))
            found = F.min(F.when(F.col("cursor") >= default, F.col("cursor")))
        aggregates.append(found.alias(f"p{n}"))
        otherwise.append(default)
    pairs = F.array(*[
        F.struct(F.lit(p).alias("position"), F.coalesce(F.col(f"p{n}"), F.lit(otherwise[n])).alias("cursor"))
        for n, p in enumerate(wanted)
    ])
    return _with_empty(groups.groupBy("shard").agg(*aggregates), n_shards).select("shard", F.inline(pairs))


def _inside(asked: ShardRange, last: str | None = None) -> Column:
    inside = (F.col("shard") == asked.shard) & (F.col("cursor") >= asked.cursor)
    if asked.end_cursor is not None:
        inside = inside & (F.col("cursor") < asked.end_cursor)
    return inside if last is None else inside & (F.col("cursor") <= last)


def _numbered(groups: DataFrame, inside: dict[int, Column]) -> DataFrame:
    """Rows once per range they lie in, with the number of the range."""
    near = groups.filter(reduce(Column.__or__, inside.values()))
    numbers = F.array(*[F.when(c, F.lit(n)) for n, c in inside.items()])
    return near.select("*", F.explode(F.array_compact(numbers)).alias("range"))


def pull_logs(groups: DataFrame, ranges: Sequence[ShardRange], max_groups: int) -> DataFrame:
    """At most `max_groups` groups of every range of a shard from `cursor` up to, excluding, `end_cursor`.

    `range` numbers the ranges from 0, several may lie in one shard; `place` counts the groups of a range
    from 1. The places come from shards and cursors alone. The last cursor of every range, a value for
    each range the caller gave, is found first and becomes a filter, so the logs are read once and only
    as far as they are asked for.
    """
    return pull_on(groups, ranges, max_groups)[0]


def pull_on(groups: DataFrame, ranges: Sequence[ShardRange], max_groups: int) -> tuple[DataFrame, list[ShardRange]]:
    """`pull_logs`, and the ranges to go on with, for a reader that pulls again at once. Ranges without groups stay as they
    are; it has caught up where all do.

    The positions are those of `next_cursors`, but come from the bounds that a pull finds anyway, so nothing that was
    pulled is read for them.
    """
    if not ranges:
        raise ValueError("pull_logs needs at least one shard")
    in_order = F.row_number().over(W.partitionBy("range").orderBy("cursor"))
    narrow = _numbered(groups.select("shard", "cursor"), {n: _inside(r) for n, r in enumerate(ranges)})
    first = narrow.withColumn("place", in_order).filter(F.col("place") <= max_groups)
    bounds = first.groupBy("range").agg(F.max("cursor").alias("last")).withColumn("next", after(F.col("last"))).collect()
    last, behind = {r["range"]: r["last"] for r in bounds}, {r["range"]: r["next"] for r in bounds}
    bounded = {n: _inside(ranges[n], end) for n, end in last.items()} or {0: F.lit(False)}
    near = _numbered(groups.select("shard", "cursor"), bounded).withColumn("place", in_order)
    if max_groups * len(ranges) <= _FEW_GROUPS:
        near = F.broadcast(near)
    pulled = _numbered(groups, bounded).join(near, ["range", "shard", "cursor"]).select(*groups.columns, "range", "place")
    return pulled, [replace(r, cursor=behind.get(n, r.cursor)) for n, r in enumerate(ranges)]


def next_cursors(pulled: DataFrame, ranges: Sequence[ShardRange]) -> DataFrame:
    """Where to go on after a pull, one row per range. Zero groups mean caught up; the position then
    stays, so that groups still to come are found."""
    asked = pulled.sparkSession.createDataFrame(
        [(n, r.shard, r.cursor) for n, r in enumerate(ranges)], "range int, shard int, cursor string"
    )
    seen = pulled.groupBy("range").agg(
        F.count(F.lit(1)).alias("n_groups"), F.max("cursor").alias("last_cursor")
    )
    return asked.join(seen, "range", "left").select(
        "range", "shard",
        F.coalesce("n_groups", F.lit(0)).cast("bigint").alias("n_groups"),
        F.coalesce(after(F.col("last_cursor")), F.col("cursor")).alias("next_cursor"),
    )
