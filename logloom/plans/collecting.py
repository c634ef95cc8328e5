"""The collection pipeline: lines of files to logs in the stores of their destinations."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.model import CollectConfig
from logloom.operators.collect import (
    assemble_records, extract_fields, keeps, parse_log_time, topic_of,
)
from logloom.operators.ingest import assign_shard, pack_log_groups
from logloom.operators.routing import route_records
from logloom.plans.scratch import scratch_path
from logloom.sources.store import put_batch, put_logs


@dataclass(frozen=True)
class Packing:
    """How collected logs are stored: shards, logs per group, window of a group in seconds, and the UNIX
    time of their arrival (none means now)."""

    shards: int
    max_logs: int = 4096
    window_s: int = 3600
    arrival: int | None = None


def collect_logs(lines: DataFrame, config: CollectConfig, source: Column, ingest_time: int | None = None,
                 group_topic: str | None = None) -> DataFrame:
    """Records of one config with `time`, `topic`, `contents` and destination, or a `reject_reason`.

    `source` names the machine a file comes from, as a column over `file_path`, which has to tell the
    files of different machines apart; it is part of the log id. Rejected, with all their text, are
    records that do not match the extraction regex, whose time does not parse, and records of more than
    `config.max_lines` lines, as a whole. Logs that the filters exclude are left out.
    """
    return _collect_alike(lines, [config], source, None, ingest_time, group_topic)


def _collect_alike(lines: DataFrame, configs: Sequence[CollectConfig], source: Column, routes: DataFrame | None,
                   ingest_time: int | None, group_topic: str | None) -> DataFrame:
    """`collect_logs` of configs that read records alike: records are assembled and parsed once, then each goes to
    the configs that take it."""
    first = configs[0]
    records = assemble_records(lines, first.log_begin_regex, first.max_lines)
    logs = extract_fields(records, first.regex, first.keys)
    logs = parse_log_time(logs, first.time_key, first.time_format, ingest_time)
    reason = (
        F.when(F.col("oversize"), "record has too many lines")
        .when(F.col("reject_reason").isNotNull(), F.col("reject_reason"))
        .when(F.col("time").isNull(), "time does not parse")
    )
    logs = logs.withColumn("reject_reason", reason)
    covers = lambda c: F.lit(True)
    if routes is not None:
        logs = logs.join(routes.groupBy("file_path").agg(F.collect_set("config_name").alias("covered_by")), "file_path")
        covers = lambda c: F.array_contains("covered_by", c.name)
    takers = F.array_compact(F.array(*[
        F.when(covers(c) & (F.col("reject_reason").isNotNull() | keeps(c.filter_keys, c.filter_regex)), c.name)
        for c in configs]))
    logs = logs.withColumn("group_topic", F.lit(group_topic).cast("string")).withColumn("source", source.cast("string"))
    logs = logs.withColumn("config_name", F.explode(takers))
    return logs.select(
        F.concat_ws(":", "config_name", F.coalesce("source", F.lit("")), "file_path",
                    F.lpad(F.col("record").cast("string"), 12, "0")).alias("log_id"),
        "time", _by_config(configs, lambda c: topic_of(c.topic_format), lambda c: c.topic_format).alias("topic"), "source",
        F.lit(None).cast("string").alias("reserved"),
        "contents",
        "config_name",
        _by_config(configs, lambda c: F.lit(c.project), lambda c: c.project).alias("project"),
        _by_config(configs, lambda c: F.lit(c.logstore), lambda c: c.logstore).alias("logstore"),
        "file_path", "record", "part", "n_lines",
        F.when(F.col("reject_reason").isNotNull(), F.col("body")).alias("body"),
        "reject_reason",
    )


def _by_config(configs: Sequence[CollectConfig], value: Callable[[CollectConfig], Column],
               key: Callable[[CollectConfig], str]) -> Column:
    """What the config of a row says; configs of one key say the same."""
    ways: dict[str, list[CollectConfig]] = {}
    for config in configs:
        ways.setdefault(key(config), []).append(config)
    *others, last = ways.values()
    return reduce(lambda rest, own: F.when(F.col("config_name").isin([c.name for c in own]), value(own[0])).otherwise(rest),
                  others, value(last[0]))


def _reading(config: CollectConfig) -> tuple:
    """How a config makes logs of lines, before it filters and names them."""
    return (config.log_begin_regex, config.max_lines, config.regex, tuple(config.keys), config.time_key, config.time_format)


def routes_of(lines: DataFrame, configs: Sequence[CollectConfig], members: DataFrame, bindings: DataFrame,
              source: Column) -> DataFrame:
    """(file_path, config_name) of the files each config covers, by the machines its groups have."""
    spark = lines.sparkSession
    known = spark.createDataFrame(
        [(c.name, c.log_path, c.file_pattern) for c in configs], "config_name string, log_path string, file_pattern string")
    files = lines.select("file_path").distinct().withColumn("machine_id", source.cast("string"))
    return route_records(files, members, bindings, known).select("file_path", "config_name")


def collect_configs(lines: DataFrame, configs: Sequence[CollectConfig], source: Column,
                    routes: DataFrame | None = None, ingest_time: int | None = None) -> DataFrame:
    """`collect_logs` for several configs. With `routes` each takes the files routed to it only.

    Configs that read records alike, whatever they filter and wherever their logs go, share one pass. Routes are
    far fewer than lines and computed once, into the scratch folder, so that Spark knows their size beforehand and
    sends them to the lines where it allows; no line is shuffled to meet them.
    """
    names = [c.name for c in configs]
    if len(set(names)) < len(names):
        raise ValueError("configs need names of their own")
    if routes is not None:
        spark, held = lines.sparkSession, scratch_path(lines.sparkSession, "routes")
        routes.select("file_path", "config_name").write.parquet(held)
        routes = spark.read.schema("file_path string, config_name string").parquet(held)
    alike: dict[tuple, list[CollectConfig]] = {}
    for config in configs:
        alike.setdefault(_reading(config), []).append(config)
    collected = []
    for group in alike.values():
        own, mine = lines, None
        if routes is not None:
            mine = routes.filter(F.col("config_name").isin([c.name for c in group]))
            own = lines.join(mine, "file_path", "left_semi")
        collected.append(_collect_alike(own, group, source, mine, ingest_time, None))
    return reduce(DataFrame.unionByName, collected)


def accepted(collected: DataFrame) -> DataFrame:
    """Logs of a collection, ready for `assign_shard`."""
    return collected.filter(F.col("reject_reason").isNull()).select(
        "log_id", "time", "topic", "source", "reserved", "contents", "project", "logstore"
    )


def rejected(collected: DataFrame) -> DataFrame:
    """What a collection could not use, with its text and the reason."""
    return collected.filter(F.col("reject_reason").isNotNull()).select(
        "config_name", "source", "file_path", "record", "part", "n_lines", "body", "reject_reason"
    )


def check_destinations(configs: Sequence[CollectConfig]) -> list[tuple[str, str]]:
    """Destinations of the configs, each once; a config has to name one."""
    nameless = [c.name for c in configs if not c.project or not c.logstore]
    if nameless:
        raise ValueError(f"configs without project or logstore: {', '.join(nameless)}")
    return list(dict.fromkeys((c.project, c.logstore) for c in configs))


def store_path(path: str, project: str, logstore: str) -> str:
    """Store of a destination below the path of a collection."""
    return f"{path}/stores/{project}/{logstore}"


def rejects_path(path: str) -> str:
    """Rejects of a collection."""
    return f"{path}/rejects"


def write_collected(collected: DataFrame, configs: Sequence[CollectConfig], path: str, packing: Packing,
                    folder: str | None = None) -> None:
    """Put the logs into the stores of their destinations and the rejects beside them.

    The collection is computed once, into the scratch folder, where each destination has a folder. With a `folder` every store gets the logs
    there, replacing what an earlier attempt has left; without, they are appended.
    """
    destinations = check_destinations(configs)
    spark = collected.sparkSession
    held = scratch_path(spark, "collected")
    collected.write.partitionBy("project", "logstore").parquet(held)
    collected = spark.read.schema(collected.schema).parquet(held).select(*collected.columns)
    refused = rejected(collected).write
    if folder is None:
        refused.mode("append").parquet(rejects_path(path))
    else:
        refused.mode("overwrite").parquet(f"{rejects_path(path)}/{folder}")
    for project, logstore in destinations:
        logs = accepted(collected).filter((F.col("project") == project) & (F.col("logstore") == logstore))
        groups = pack_log_groups(assign_shard(logs, packing.shards), packing.max_logs, packing.window_s, packing.arrival)
        if folder is None:
            put_logs(groups, store_path(path, project, logstore))
        else:
            put_batch(groups, f"{store_path(path, project, logstore)}/{folder}")
