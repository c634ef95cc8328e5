"""The test tables as logs, lines, groups and fleets."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from dataclasses import replace
from itertools import groupby
from pathlib import Path
from urllib.parse import urlparse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.functions.fields import make_contents
from logloom.functions.times import seconds, utc_date
from logloom.model import CollectConfig
from logloom.operators.ingest import assign_shard, flatten_log_groups, pack_log_groups
from logloom.plans.collecting import Packing
from logloom.plans.scratch import scratch_path
from logloom.sources.store import put_logs, read_groups

DAY = 86_400
JAN_1 = 1_704_067_200
JAN_2 = JAN_1 + DAY
JAN_15 = JAN_1 + 14 * DAY
JAN_31 = JAN_1 + 30 * DAY
SHARDS = 4
MAX_LOGS = 2
BLOCK_LINES = 16
BUCKETS = 16
#: Words to look up together.
TERMS = ("Hath", "una", "the")

PACKING = Packing(shards=SHARDS, max_logs=50, window_s=DAY, arrival=JAN_31)
TEXTS = CollectConfig(
    name="texts",
    log_path="/var/log",
    file_pattern="*.txt",
    log_begin_regex=r"\[[^\]]*\] doc=[0-9]+ lang=[a-z]+",
    regex=r"\[([^\]]*)\] doc=([0-9]+) lang=([a-z]+)\n(.*)",
    keys=("time", "doc", "lang", "message"),
    time_key="time",
    time_format="%Y/%m/%d %H:%M:%S",
    filter_keys=("lang", ""),
    filter_regex=("en|fr|de", ""),
    topic_format=".*/lang=([^/]*)/.*",
    project="library",
    logstore="texts",
)
COLLECT_CONFIGS = (TEXTS, replace(TEXTS, name="spanish", filter_regex=("es", ""), logstore="spanish"))


def machine_of_file():
    """The machine a file of documents comes from, by its path."""
    return F.regexp_extract("file_path", "/source=([^/]*)/", 1)


def configs_below(path: str) -> list[CollectConfig]:
    """The configs for files that lie below a folder."""
    return [replace(c, log_path=path) for c in COLLECT_CONFIGS]


def collecting_fleet(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Sources as machines: all are in one group, which both configs apply to, but src1 only in another,
    which has the first."""
    machine = table(spark, sf_dir, "documents").select(F.col("source").alias("machine_id")).distinct()
    group = F.when(F.col("machine_id") == "src1", "one").otherwise("most")
    members = machine.select(group.alias("group_name"), "machine_id", F.lit("").alias("group_topic"))
    bindings = spark.createDataFrame(
        [("texts", "one"), ("texts", "most"), ("spanish", "most")], "config_name string, group_name string")
    return members, bindings


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _as_logs(df: DataFrame, number: str, time, topic: str, source, contents) -> DataFrame:
    return df.select(
        F.lpad(F.col(number).cast("string"), 20, "0").alias("log_id"),
        time.alias("time"),
        F.col(topic).alias("topic"),
        source.cast("string").alias("source"),
        F.lit(None).cast("string").alias("reserved"),
        contents.alias("contents"),
    ).withColumn("date", utc_date(F.col("time")))


def _at(time: int):
    return F.lit(str(dt.datetime.fromtimestamp(time, dt.timezone.utc).replace(tzinfo=None))).cast("timestamp_ntz")


def events_as_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = {"value": F.col("value"), "k": F.get_json_object("props", "$.k")}
    logs = _as_logs(table(spark, sf_dir, "events"), "event_id", seconds(F.col("ts")), "event_type", F.col("user_id"),
                    make_contents(list(values.items())))
    return assign_shard(logs, SHARDS)


def documents_as_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    time = (F.lit(JAN_1) + F.col("doc_id") * 60).cast("bigint")
    logs = _as_logs(
        table(spark, sf_dir, "documents"), "doc_id", time, "lang", F.col("source"),
        make_contents([("text", F.col("text"))]),
    )
    return assign_shard(logs, SHARDS)


def event_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of events that arrive with the newest of their logs."""
    return pack_log_groups(events_as_logs(spark, sf_dir), MAX_LOGS, DAY, arrival=F.col("max_time"))


def event_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The groups of events, written and read back."""
    path = scratch_path(spark, "store")
    put_logs(event_groups(spark, sf_dir), path)
    return read_groups(spark, path)


def stored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The logs of that store."""
    return flatten_log_groups(event_store(spark, sf_dir))


def document_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat(F.lit("/var/log/"), F.col("source"), F.lit("/"), F.col("lang"), F.lit("/"),
                    F.col("doc_id").cast("string"), F.lit(".LOG"))
    return table(spark, sf_dir, "documents").select("*", path.alias("file_path"))


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = document_paths(spark, sf_dir).select(
        "file_path", F.posexplode(F.split("text", "\n")).alias("line_id", "line")
    )
    return lines.select("file_path", F.floor(F.col("line_id") / BLOCK_LINES).alias("block_start"), "line", "line_id")


def slashed(ts):
    """A TIMESTAMP_NTZ as %Y/%m/%d %H:%M:%S, whatever the session time zone."""
    return F.translate(ts.cast("string"), "-", "/")


def written_times(ts) -> list[tuple]:
    """A TIMESTAMP_NTZ in several time formats, each with its format."""
    padded = F.lpad(F.day(ts).cast("string"), 2, " ")
    clock = F.substring(ts.cast("string"), 12, 8)
    name = lambda pattern: F.date_format(ts, pattern)
    return [
        ("%Y/%m/%d %H:%M:%S", slashed(ts)),
        ("%d/%b/%Y:%T %z", F.concat(name("dd/MMM/yyyy"), F.lit(":"), clock, F.lit(" Z"))),
        ("%a %b %e %H:%M:%S %Y", F.concat(name("EEE MMM "), padded, F.lit(" "), clock, name(" yyyy"))),
        ("%m/%d/%y %I:%M:%S %p", F.concat(name("MM/dd/yy hh:mm:ss "), F.when(F.hour(ts) < 12, "AM").otherwise("PM"))),
        ("%FT%T%z", F.concat(name("yyyy-MM-dd"), F.lit("T"), clock, F.lit("+00:00"))),
        ("%A, %d %B %Y %R:%S 100%%", F.concat(name("EEEE, dd MMMM yyyy "), clock, F.lit(" 100%"))),
        ("%Y%j%H%M%S", F.concat(name("yyyyDDD"), F.replace(clock, F.lit(":")))),
    ]


def append_events(spark: SparkSession, sf_dir: str, folder: str, step: int, steps: int, rotate: bool = False,
                  two_lines: bool = False) -> None:
    """One step's share of the events' lines, appended to a log file per type by a task each. All but the last step
    leave the end of their last line to the next one; a rotation gives the old file another name first. With `two_lines`
    an event's value is on a line of its own."""
    end = b"|end\n"

    def opened(kind: str | None):
        path = Path(urlparse(folder).path) / f"{kind}.log"
        path.parent.mkdir(parents=True, exist_ok=True)
        if rotate and path.exists():
            # The writer finishes its line before it moves on.
            with open(path, "ab") as file:
                file.write(end)
            path.rename(path.with_name(f"{path.name}.{step}"))
        return open(path, "ab")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Lines in the order of their types, a batch in memory at a time."""
        file, last = None, None
        for batch in batches:
            rows = zip(batch["event_type"].to_pylist(), batch["line"].to_pylist(), strict=True)
            for kind, own in groupby(rows, key=lambda r: r[0]):
                goes_on = file is not None and kind == last
                if not goes_on:
                    if file is not None:
                        file.write(end if step == steps - 1 else b"")
                        file.close()
                    file, last = opened(kind), kind
                begin = end if goes_on or (step and not rotate) else b""
                file.write(begin + end.join(line.encode() for _, line in own))
        if file is not None:
            file.write(end if step == steps - 1 else b"")
            file.close()
        yield from ()

    line = F.concat_ws("|", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), "event_id", "event_type", "value")
    if two_lines:
        line = F.concat(F.lit("EVENT|"), F.concat_ws("|", "event_id", "event_type"), F.lit("\n |"), F.col("value").cast("string"))
    mine = table(spark, sf_dir, "events").filter(F.pmod(F.col("event_id"), F.lit(steps)) == step)
    rows = mine.select("event_type", "event_id", line.alias("line")).repartition("event_type")
    rows.sortWithinPartitions("event_type", "event_id").mapInArrow(write, "n bigint").collect()


def write_document_files(spark: SparkSession, sf_dir: str) -> str:
    """Documents as log files with a header line each; those of one source have an unusable time."""
    path = scratch_path(spark, "files")
    at = slashed(F.timestamp_add("SECOND", F.col("doc_id") * 60, _at(JAN_1)))
    stamp = F.when(F.col("source") == "src3", "no time").otherwise(at)
    record = F.concat(F.lit("["), stamp, F.lit("] doc="), F.col("doc_id").cast("string"), F.lit(" lang="),
                      F.col("lang"), F.lit("\n"), F.col("text"))
    (
        table(spark, sf_dir, "documents").select(record.alias("value"), "source", "lang")
        .hint("rebalance", "source", "lang").write.partitionBy("source", "lang").text(path)
    )
    return path


def pages_as_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("body"))


#: Days at which the feed of orders is cut into steps.
ORDER_DAYS = ("1994-06-01", "1996-06-01")


def order_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a feed of changes; (date, key) is its order."""
    return table(spark, sf_dir, "orders").withColumn("position", F.struct("o_orderdate", "o_orderkey"))


def machines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as machines: an IP of their own, a user-defined id per nation."""
    key = F.col("s_suppkey")
    octets = [F.floor(key / 65536), F.floor(key / 256) % 256, key % 256]
    return table(spark, sf_dir, "supplier").select(
        F.concat_ws(".", F.lit("10"), *[o.cast("string") for o in octets]).alias("ip"),
        F.col("s_name").alias("unique_id"),
        F.concat(F.lit("nation-"), F.col("s_nationkey").cast("string")).alias("userdefined_id"),
        "s_suppkey", "s_nationkey",
    )


def machine_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as groups: even ones list their user-defined id, odd ones the IPs of their machines,
    at most 1,000 per row."""
    nations = table(spark, sf_dir, "nation")
    by_id = nations.filter(F.col("n_nationkey") % 2 == 0).select(
        F.col("n_name").alias("group_name"), F.lit("userdefined").alias("id_type"),
        F.array(F.concat(F.lit("nation-"), F.col("n_nationkey").cast("string"))).alias("machine_list"),
    )
    by_ip = (
        machines(spark, sf_dir).filter(F.col("s_nationkey") % 2 == 1)
        .groupBy("s_nationkey", F.floor(F.col("s_suppkey") / 1000).alias("piece"))
        .agg(F.collect_list("ip").alias("machine_list"))
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(F.col("n_name").alias("group_name"), F.lit("ip").alias("id_type"), "machine_list")
    )
    return by_id.unionByName(by_ip)


def route_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Events as records of customers' machines; nations are groups, two configs per region."""
    machine = F.col("user_id").cast("string")
    records = table(spark, sf_dir, "events").select(
        "event_id", machine.alias("machine_id"), seconds(F.col("ts")).alias("time"),
        F.concat(F.lit("/var/log/"), F.col("event_type"), F.lit("/"), machine, F.lit(".LOG")).alias("file_path"),
    )
    nations = table(spark, sf_dir, "nation")
    members = table(spark, sf_dir, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("group_name"), F.col("c_custkey").cast("string").alias("machine_id"),
        F.concat(F.lit("topic-"), F.col("n_name")).alias("group_topic"),
    )
    regions = table(spark, sf_dir, "region")
    kinds = F.explode(F.array(F.lit("all"), F.lit("errors"))).alias("kind")
    bindings = nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_name", "r_name", kinds
    ).select(F.concat_ws("-", "kind", "r_name").alias("config_name"), F.col("n_name").alias("group_name"))
    is_all = F.col("kind") == "all"
    configs = regions.select("r_name", kinds).select(
        F.concat_ws("-", "kind", "r_name").alias("config_name"),
        F.when(is_all, "/var/log").otherwise("/var/log/error/").alias("log_path"),
        F.when(is_all, "*.LOG").otherwise("1?.*").alias("file_pattern"),
        F.col("r_name").alias("project"),
        F.col("kind").alias("logstore"),
    )
    return records, members, bindings, configs


def binding_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as changes of what is bound to their customer's nation, spread over the month of the events."""
    orders, customer, nation, region = (table(spark, sf_dir, n) for n in ("orders", "customer", "nation", "region"))
    kind = F.when(F.col("o_orderkey") % 2 == 0, "all").otherwise("errors")
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.concat_ws("-", kind, "r_name").alias("config_name"), F.col("n_name").alias("group_name"),
            F.when(F.col("o_orderstatus") == "F", "remove").otherwise("apply").alias("op"),
            (F.lit(JAN_1) + F.col("o_orderkey") * 7919 % (30 * DAY)).cast("bigint").alias("time"),
            F.col("o_orderkey").alias("position"))
    )
