"""Machines, machine groups, collection configs and what binds them.

Joins leave hot keys to adaptive execution, which splits a large partition of either side when it sees
the shuffled sizes; that reads every input once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.model import ID_TYPE_USERDEFINED


def expand_machine_groups(groups: DataFrame, machines: DataFrame) -> DataFrame:
    """Machines of every group: (group_name, ip, unique_id, userdefined_id).

    A group lists user-defined ids or, for any other id type, IPs. Its list may be spread over
    several rows.
    """
    userdefined = F.col("id_type") == ID_TYPE_USERDEFINED
    members = groups.select(
        "group_name",
        F.when(userdefined, "userdefined").otherwise("ip").alias("id_kind"),
        F.explode("machine_list").alias("machine_id"),
    ).dropDuplicates()
    ids = F.array(
        F.struct(F.lit("userdefined").alias("id_kind"), F.col("userdefined_id").alias("machine_id")),
        F.struct(F.lit("ip").alias("id_kind"), F.col("ip").alias("machine_id")),
    )
    known = (
        machines.select("ip", "unique_id", "userdefined_id", F.inline(ids))
        .filter(F.col("machine_id").isNotNull())
    )
    return known.join(members, ["id_kind", "machine_id"]).select("group_name", "ip", "unique_id", "userdefined_id")


def machine_totals(members: DataFrame) -> DataFrame:
    """Number of machines per group."""
    return members.groupBy("group_name").agg(F.count(F.lit(1)).alias("total"))


def applied_configs(bindings: DataFrame, group: str | None = None) -> DataFrame:
    """Configs applied to every group, or to one, a row each. A config may be bound to any number
    of groups, hence rows and not lists."""
    chosen = bindings if group is None else bindings.filter(F.col("group_name") == group)
    return chosen.select("group_name", "config_name").dropDuplicates()


def applied_machine_groups(bindings: DataFrame, config: str | None = None) -> DataFrame:
    """Groups that every config, or one, is applied to, a row each."""
    chosen = bindings if config is None else bindings.filter(F.col("config_name") == config)
    return chosen.select("config_name", "group_name").dropDuplicates()


def current_bindings(changes: DataFrame) -> DataFrame:
    """Pairs bound after a feed of changes (config_name, group_name, op, position) with op `apply` or
    `remove`; the last change of a pair decides."""
    return (
        changes.groupBy("config_name", "group_name")
        .agg(F.max_by("op", "position").alias("op"))
        .filter(F.col("op") == "apply")
        .select("config_name", "group_name")
    )


def entity_snapshot(changes: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """Entities that exist after a feed of changes (name, op, time, position, attributes...) with op
    `create`, `update` or `delete`, with their present attributes.

    An entity lives from its first change after its last deletion; `position` orders the feed and is
    unique. Both passes aggregate before they shuffle.
    """
    deleted = (
        changes.filter(F.col("op") == "delete")
        .groupBy("name").agg(F.max("position").alias("deleted_at"))
    )
    feed = changes.select("name", "op", "time", "position", *attributes)
    living = feed.join(deleted, "name", "left").filter(
        F.col("deleted_at").isNull() | (F.col("position") > F.col("deleted_at"))
    )
    return living.groupBy("name").agg(
        F.min_by("time", "position").alias("create_time"),
        F.max_by("time", "position").alias("modify_time"),
        *[F.max_by(a, "position").alias(a) for a in attributes],
    )


def missing_targets(refs: DataFrame, snapshot: DataFrame, name: str = "name") -> DataFrame:
    """Referenced names that do not exist, with the number of references. References are counted
    before the join, so a name referenced very often is one row in it."""
    return (
        refs.groupBy(name).agg(F.count(F.lit(1)).alias("n_refs"))
        .join(snapshot.select(name), name, "left_anti")
    )
