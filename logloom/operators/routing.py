"""Which configs take which records: by path, by what is bound, and by when it was bound.

A record or file meets the groups of its machine and then, for each folder above it, the configs bound there: group
and folder are equi keys, so nothing meets the other configs of its groups, and no table of machines times configs
is made. Hot machines, folders and files are left to adaptive execution, which splits them; the smaller sides are sent
where their size allows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from logloom.model import MAX_TIME
from logloom.operators.collect import glob_regex

#: Changes of a pair, and the seconds asked for, are ordered within periods of so many seconds, so that no pair is one group.
PERIOD = 86_400

_CONFIG = ["config_name", "log_path", "file_pattern"]
_PAIR = ["config_name", "group_name"]


def _covers(pattern: Column, name: Column) -> Column:
    """Whether a file name matches a glob. The usual ones, with a star at one end and nothing else, are
    tests of literal text; a regex is made for the others only."""
    special = r"[*?]"
    begin, end = F.substring(pattern, 1, 1), F.substring(pattern, -1, 1)
    head, tail = F.expr("substring(file_pattern, 1, length(file_pattern) - 1)"), F.substring(pattern, 2, 1 << 30)
    return (
        F.when(pattern == "*", F.lit(True))
        .when(~pattern.rlike(special), name == pattern)
        .when((begin == "*") & ~tail.rlike(special), F.endswith(name, tail))
        .when((end == "*") & ~head.rlike(special), F.startswith(name, head))
        .otherwise(F.rlike(name, F.concat(F.lit(r"\A"), glob_regex(pattern), F.lit(r"\z"))))
    )



def _folders(path: Column) -> Column:
    """All folders above a file, each with its slash at the end; NULL where there is none."""
    parts = F.split(path, "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda n: F.concat(F.array_join(F.slice(parts, 1, n), "/"), F.lit("/")))
    return F.when(F.size(parts) > 1, above)


def _bound_folders(bindings: DataFrame, configs: DataFrame) -> DataFrame:
    """Bindings with the path of their config, and its folder as `_folder`."""
    folder = F.concat(F.rtrim("log_path", F.lit("/")), F.lit("/")).alias("_folder")
    return bindings.join(configs.select("*", folder), "config_name")


def _covered(files: DataFrame, members: DataFrame, bound: DataFrame) -> DataFrame:
    """Files of machines times the bindings whose folder and pattern cover them."""
    below = files.join(members, "machine_id").withColumn("_folder", F.explode(_folders(F.col("file_path"))))
    name = F.substring_index("file_path", "/", -1)
    found = below.join(bound, ["group_name", "_folder"]).filter(_covers(F.col("file_pattern"), name))
    return found.drop("_folder", "log_path", "file_pattern")


def _once_per_machine(members: DataFrame, bindings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members with the groups of their machine that come before theirs (`_before`), and bindings with the groups
    before theirs, of those that share a machine with it, that their config is bound to as well (`_also`). A way in
    which the two have a group in common is not the first one."""
    members = members.groupBy("group_name", "machine_id").agg(F.min("group_topic").alias("group_topic"))
    groups = members.groupBy("machine_id").agg(F.collect_set("group_name").alias("_groups"))
    before = F.filter("_groups", lambda g: g < F.col("group_name"))
    members = members.join(groups, "machine_id").withColumn("_before", before).drop("_groups")
    bindings = bindings.select(*_PAIR).distinct()
    meet = members.select("group_name", F.explode("_before").alias("_earlier")).distinct()
    earlier = bindings.withColumnRenamed("group_name", "_earlier")
    also = bindings.join(meet, "group_name").join(earlier, ["config_name", "_earlier"]).groupBy(*_PAIR).agg(
        F.collect_set("_earlier").alias("_also"))
    return members, bindings.join(also, _PAIR, "left")


def route_records(records: DataFrame, members: DataFrame, bindings: DataFrame, configs: DataFrame) -> DataFrame:
    """Records (machine_id, file_path, ...) times the destinations of every config that is applied to
    their machine's group and covers their path, with group_name and group_topic; records no config covers are not
    collected. A config that reaches a machine through several groups counts once, with the first of these groups.

    Records are read once. Records of many lines per file are better routed by file, see `routes_of`.
    """
    members, bindings = _once_per_machine(members.select("group_name", "machine_id", "group_topic"), bindings)
    found = _covered(records, members, _bound_folders(bindings, configs))
    first = ~F.coalesce(F.arrays_overlap("_before", "_also"), F.lit(False))
    return found.filter(first).drop("_before", "_also")


def binding_intervals(changes: DataFrame) -> DataFrame:
    """When what was bound: (config_name, group_name, bound_from, bound_to) from a feed of changes (config_name,
    group_name, op, time, position) with op `apply` or `remove`; bound_to is NULL where it still is.

    A change holds from its second on, and of several in one second the one of the last position. A pair's intervals
    neither overlap nor touch. Changes are ordered within a period; what a period hands to the next one is a
    row per pair and period, so a pair that changes all the time is no single group.
    """
    period = F.floor(F.col("time") / PERIOD).alias("period")
    seconds = changes.groupBy(*_PAIR, "time", period).agg((F.max_by("op", "position") == "apply").alias("on"))
    key = [*_PAIR, "period"]
    pair = W.partitionBy(*_PAIR).orderBy("period")
    inside = W.partitionBy(*key).orderBy("time")
    before = seconds.groupBy(*key).agg(F.max_by("on", "time").alias("last")).select(
        *key, F.coalesce(F.lag("last").over(pair), F.lit(False)).alias("handed"))
    turns = (
        seconds.join(before, key)
        .withColumn("was", F.coalesce(F.lag("on").over(inside), F.col("handed")))
        .filter(F.col("on") != F.col("was")).drop("was", "handed")
    )
    after = turns.groupBy(*key).agg(F.min("time").alias("first")).select(*key, F.lead("first").over(pair).alias("next"))
    return (
        turns.join(after, key)
        .withColumn("bound_to", F.coalesce(F.lead("time").over(inside), F.col("next")))
        .filter("on").select(*_PAIR, F.col("time").alias("bound_from"), "bound_to")
    )


def _held_at(moments: DataFrame, intervals: DataFrame) -> DataFrame:
    """The moments (config_name, group_name, time) at which an interval of their pair holds, each once.

    Moments and ends of intervals are ordered within a period, at most a row per second there; what a period hands to
    the next one is a row per pair and period.
    """
    end = F.coalesce("bound_to", F.lit(MAX_TIME + 1))
    turn = lambda at, by: F.struct(at.cast("bigint").alias("time"), F.lit(by).alias("turn"))
    turns = intervals.filter(F.col("bound_from") < end).select(
        *_PAIR, F.inline(F.array(turn(F.col("bound_from"), 1), turn(end, -1))), F.lit(False).alias("asked"))
    asked = moments.select(*_PAIR, F.col("time").cast("bigint").alias("time"), F.lit(0).alias("turn"), F.lit(True).alias("asked"))
    period = F.floor(F.col("time") / PERIOD).alias("period")
    seconds = asked.unionByName(turns).groupBy(*_PAIR, "time", period).agg(
        F.sum("turn").alias("turn"), F.bool_or("asked").alias("asked"))
    key = [*_PAIR, "period"]
    earlier = W.partitionBy(*_PAIR).orderBy("period").rowsBetween(W.unboundedPreceding, -1)
    handed = seconds.groupBy(*key).agg(F.sum("turn").alias("sum"), F.bool_or("asked").alias("any")).select(
        *key, "any", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("handed")).filter("any").drop("any")
    upto = W.partitionBy(*key).orderBy("time").rowsBetween(W.unboundedPreceding, 0)
    known = seconds.join(handed, key).withColumn("open", F.col("handed") + F.sum("turn").over(upto))
    return known.filter("asked and open > 0").select(*_PAIR, "time")


def route_records_in_time(records: DataFrame, members: DataFrame, intervals: DataFrame, configs: DataFrame) -> DataFrame:
    """`route_records` by what was bound at the `time` of each record, see `binding_intervals`.

    A record's ways, bound at any time, are narrowed to those open at its second: the seconds asked for are put in
    order with the turns of each pair, so no record meets the other intervals of its pairs, and many files that
    ask for the same second of a pair ask once. Records are read twice, first for machine, file and second alone.
    Records without a time go nowhere.
    """
    key = ["machine_id", "file_path", "time"]
    moments = records.filter(F.col("time").isNotNull()).select(*key).distinct()
    paths = configs.select(*_CONFIG).withColumn("_config", F.struct(*_CONFIG))
    bound = _bound_folders(intervals.select(*_PAIR).distinct(), paths)
    found = _covered(moments, members.select("group_name", "machine_id", "group_topic"), bound)
    open_ = found.join(_held_at(found.select(*_PAIR, "time"), intervals), [*_PAIR, "time"])
    # A config that reaches a machine through several groups counts once, with the first of these.
    routes = open_.groupBy(*key, "_config").agg(F.min(F.struct("group_name", "group_topic")).alias("_way"))
    routes = routes.select(*key, "_config.*", "_way").join(configs, _CONFIG).drop("log_path", "file_pattern")
    routed = records.join(routes, key)
    own = [c for c in records.columns if c not in key[:2]]
    more = [c for c in routes.columns if c not in (*key, "_way")]
    return routed.select(*[F.col(f"`{c}`") for c in (*key[:2], *own, *more)], "_way.group_name", "_way.group_topic")
