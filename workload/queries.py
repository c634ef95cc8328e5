"""One query per operator: (session, folder of the tables) -> DataFrame of flat columns."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.functions.cursors import cursor_at
from logloom.functions.fields import field, key_compare, key_term_match, make_contents, term_match
from logloom.functions.times import seconds
from logloom.model import MAX_TIME, IndexKey, IndexLine, Shard, ShardRange
from logloom.operators import collect, consume, fleet, index, ingest, rollups, routing, search, shards
from logloom.plans.collecting import collect_configs, rejects_path, routes_of, store_path, write_collected
from logloom.plans.scratch import scratch_path
from logloom.sources import growing, puts, store
from logloom.sources.files import read_log_files, stream_log_files
from logloom.streaming import entities, live, records, runs
from logloom.streaming import store as stream_store
from logloom.streaming.collecting import collect_stream
from workload import tables as t

Query = Callable[[SparkSession, str], DataFrame]

LINE = IndexLine(token=(",", ":", " "))
TEXT = IndexKey(type="text", token=(",", ":", " "))
RANGES = [ShardRange(n, cursor_at(t.JAN_15)) for n in range(t.SHARDS)]
URL_REGEX = r"(https?)://([^/]+)/([a-z]+)/([0-9]+)\?page=([0-9]+).*"
URL_KEYS = ("scheme", "host", "lang", "number", "page")
ROUTED = ["event_id", "machine_id", "file_path", "config_name", "project", "logstore", "group_name", "group_topic"]
TERMS = t.TERMS
PATH_TOPIC = "/var/log/([^/]*)/.*"
LATENESS = 600
#: A range of several days that starts and ends within one.
MIDDAYS = (t.JAN_2 + 40_000, t.JAN_15 + 30_000)


def _values(logs: DataFrame, *columns: str) -> DataFrame:
    return logs.select(*columns, field("value").alias("value"), field("k").alias("k"))


# ingest

def pack_log_groups(spark, sf_dir):
    packed = F.transform("logs", lambda l: F.concat_ws(
        "/", l["time"].cast("string"), field("value", l["contents"]), field("k", l["contents"])))
    return t.event_groups(spark, sf_dir).select(
        "cursor", "shard", "topic", "source", F.col("date").cast("string").alias("date"),
        "min_time", "max_time", F.col("n_logs").cast("bigint").alias("n_logs"), "raw_size",
        F.array_join(packed, ",").alias("logs"),
    )


def flatten_log_groups(spark, sf_dir):
    return _values(ingest.flatten_log_groups(t.event_groups(spark, sf_dir)), "log_id", "time", "topic", "source", "shard")


def flatten_contents(spark, sf_dir):
    return ingest.flatten_contents(t.events_as_logs(spark, sf_dir)).select("log_id", "position", "key", "value")


def assign_shard(spark, sf_dir):
    return t.events_as_logs(spark, sf_dir).select("log_id", "source", "shard")


def _per_partition(groups: DataFrame) -> DataFrame:
    return ingest.meter_volume(groups, ["shard", F.col("date").cast("string").alias("date")])


def put_logs(spark, sf_dir):
    path = scratch_path(spark, "store")
    store.put_logs(t.event_groups(spark, sf_dir), path)
    return _per_partition(store.read_groups(spark, path))


def put_logs_stream(spark, sf_dir):
    """Groups arrive as files and are stored by a stream, in several batches."""
    arrived, path, state = (scratch_path(spark, n) for n in ("arrived", "store", "state"))
    t.event_groups(spark, sf_dir).repartition(4).write.parquet(arrived)
    schema = spark.read.parquet(arrived).schema
    groups = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(arrived)
    stream_store.put_logs_stream(groups, path, state).awaitTermination()
    return _per_partition(store.read_groups(spark, path))


def expire_logs(spark, sf_dir):
    kept = ingest.expire_logs(t.stored_events(spark, sf_dir), 14, t.JAN_31, index_ttl=7)
    return kept.select("log_id", "time", "topic")


def meter_volume(spark, sf_dir):
    return ingest.meter_volume(t.event_groups(spark, sf_dir), ["topic", "source"])


# consume

def list_shards(spark, sf_dir):
    return consume.list_shards(t.event_groups(spark, sf_dir), t.SHARDS + 1)


def resolve_cursor(spark, sf_dir):
    return consume.resolve_cursor(t.event_groups(spark, sf_dir), ["begin", "end", t.JAN_15, t.JAN_31], t.SHARDS + 1)


def pull_logs(spark, sf_dir):
    pulled = consume.pull_logs(t.event_store(spark, sf_dir), RANGES, 10)
    return pulled.select("shard", "place", "cursor", "topic", "source", F.col("n_logs").cast("bigint").alias("n_logs"))


def next_cursors(spark, sf_dir):
    pulled = consume.pull_logs(t.event_store(spark, sf_dir), RANGES, 10)
    return consume.next_cursors(pulled, RANGES)


def follow_shards(spark, sf_dir):
    """Events arrive in four puts. The first two do so in one second; the third takes its place before the fourth
    but commits behind it. A reader follows all shards in steps from the beginning, after every commit."""
    path = scratch_path(spark, "store")
    logs = t.events_as_logs(spark, sf_dir)
    quarter = F.pmod(F.xxhash64("log_id"), F.lit(4))
    follower = _Follower(spark, path)
    put = lambda n, **when: store.put_logs(
        ingest.pack_log_groups(logs.filter(quarter == n), t.MAX_LOGS, t.DAY), path, **when)
    for n in (0, 1):
        put(n, arrival=t.JAN_31)
        follower.follow()
    slow = puts.Puts(spark, path).claim(t.JAN_31)
    put(3, arrival=t.JAN_31)
    if follower.follow():
        raise AssertionError("a put was read that an unfinished one precedes")
    put(2, put=slow)
    follower.follow()
    read = reduce(DataFrame.unionByName, follower.steps)
    return _values(ingest.flatten_log_groups(read), "time", "topic", "source", "shard")


class _Follower:
    """A reader that keeps its positions."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.steps = spark, path, []
        self.ranges = [ShardRange(n, "") for n in range(t.SHARDS)]

    def follow(self) -> int:
        """Read in bounded steps until nothing is left; returns the number of steps."""
        groups = store.read_settled(self.spark, self.path)
        most = consume.list_shards(groups).agg(F.max("n_groups")).first()[0] or 0
        before = len(self.steps)
        while True:
            pulled, following = consume.pull_on(groups, self.ranges, max(1, most // 2))
            if following == self.ranges:
                return len(self.steps) - before
            self.steps.append(pulled)
            self.ranges = following


def split_shards(spark, sf_dir):
    """Events go to two shards, which are split by what they took before the rest arrives. A reader with cursors of the
    old shards goes on there and in the new ones."""
    path = scratch_path(spark, "store")
    logs = t.events_as_logs(spark, sf_dir)
    late = F.pmod(F.xxhash64("log_id"), F.lit(3)) == 0
    follower = _Follower(spark, path)

    def step(part: DataFrame, held: list[Shard]) -> list[DataFrame]:
        before = len(follower.steps)
        store.put_logs(ingest.pack_log_groups(shards.assign_shard_by_range(part, held), t.MAX_LOGS, t.DAY), path, arrival=t.JAN_31)
        follower.ranges = shards.follow_ranges(held, {r.shard: r.cursor for r in follower.ranges if r.cursor})
        follower.follow()
        return follower.steps[before:]

    held = shards.even_shards(2)
    first = step(logs.filter(~late), held)
    held = shards.split_shards(logs.filter(~late), held, 0.25, t.JAN_31)
    closed = [s.shard for s in held if s.closed_at is not None]
    second = step(logs.filter(late), held)
    taken = reduce(DataFrame.unionByName, second).filter(F.col("shard").isin(closed))
    if not closed or not taken.isEmpty():
        raise AssertionError("a closed shard took a put")
    read = reduce(DataFrame.unionByName, first + second)
    return _values(ingest.flatten_log_groups(read), "time", "topic", "source")


def tail_logs(spark, sf_dir):
    """A store is written, followed from 2024-01-15 in bounded steps, and counted."""
    path, out, state = (scratch_path(spark, n) for n in ("store", "tail", "state"))
    store.put_logs(t.event_groups(spark, sf_dir), path)
    tail = stream_store.tail_logs(spark, path, max_files=10_000, start_time=t.JAN_15)
    runs.start_files(tail, out, state).awaitTermination()
    return spark.read.parquet(out).groupBy("topic").agg(
        F.count(F.lit(1)).alias("n_logs"), F.min("time").alias("first_time"), F.max("time").alias("last_time")
    )


# search

def scan_logs(spark, sf_dir):
    hits = search.scan_logs(t.stored_events(spark, sf_dir), t.JAN_2, t.JAN_2 + t.DAY, "error")
    return _values(hits, "log_id", "time", "topic", "source")


def scan_groups(spark, sf_dir):
    """The same with groups skipped by their own columns."""
    hits = search.scan_groups(t.event_store(spark, sf_dir), t.JAN_2 + 1000, t.JAN_2 + t.DAY // 2, "error")
    return _values(hits, "log_id", "time", "topic", "source", "shard")


def term_match_query(spark, sf_dir):
    hits = t.documents_as_logs(spark, sf_dir).filter(term_match("The", LINE))
    return hits.select("log_id", "time", "topic", "source")


def key_term_match_query(spark, sf_dir):
    logs = search.scan_logs(t.documents_as_logs(spark, sf_dir), t.JAN_1, MAX_TIME, "en")
    return logs.filter(key_term_match("text", "and", TEXT)).select("log_id", "time")


def key_compare_query(spark, sf_dir):
    wanted = key_compare("k", ">", 50, "long") & key_compare("value", ">=", 100, "double")
    return _values(t.events_as_logs(spark, sf_dir).filter(wanted), "log_id", "time")


def get_logs(spark, sf_dir):
    page = search.get_logs(
        t.stored_events(spark, sf_dir), "", *MIDDAYS, key_compare("k", ">", 10), lines=100, offset=100, reverse=True,
    )
    return page.select("log_id", "time", "topic", "source", F.col("fields")["value"].alias("value"),
                       F.col("fields")["k"].alias("k"))


def get_logs_by_rank(spark, sf_dir):
    """A page close to the last hit."""
    logs, wanted = t.stored_events(spark, sf_dir), key_compare("k", ">", 10)
    hits = search.histogram_total(search.get_histograms(logs, "", *MIDDAYS, wanted, t.DAY)).first()["count"]
    page = search.get_logs_by_rank(logs, "", *MIDDAYS, wanted, lines=100, offset=max(0, hits - 150))
    return page.select("log_id", "time", "topic", "source", F.col("fields")["value"].alias("value"),
                       F.col("fields")["k"].alias("k"))


def get_histograms(spark, sf_dir):
    return search.get_histograms(
        t.stored_events(spark, sf_dir), "error", t.JAN_2, t.JAN_2 + t.DAY - 100,
        key_compare("value", ">", 50, "double"), bucket_seconds=3600,
    )


def histogram_total(spark, sf_dir):
    return search.histogram_total(search.get_histograms(
        t.stored_events(spark, sf_dir), "", *MIDDAYS, key_compare("k", "<=", 50), bucket_seconds=t.DAY,
    ))


def rollup_histograms(spark, sf_dir):
    """Counts are kept beside a store; a range that cuts minutes is counted from them and from the logs at its ends."""
    path = scratch_path(spark, "rollup")
    groups = t.event_store(spark, sf_dir)
    rollups.write_rollup(groups, path, "1")
    return rollups.rollup_histograms(rollups.read_rollup(spark, path), groups, "", MIDDAYS[0] + 7, MIDDAYS[1] + 13, t.DAY)


def live_histograms(spark, sf_dir):
    """Events as a stream of several batches, the newest first, counted per hour."""
    arrived, out, state = (scratch_path(spark, n) for n in ("arrived", "buckets", "state"))
    logs = t.table(spark, sf_dir, "events").select(seconds(F.col("ts")).alias("time"))
    for part in (F.col("time") >= t.JAN_15, F.col("time") < t.JAN_15):
        logs.filter(part).repartition(2).write.mode("append").parquet(arrived)
        stream = spark.readStream.schema(logs.schema).option("maxFilesPerTrigger", 1).parquet(arrived)
        live.count_stream(stream, out, state, 3600).awaitTermination()
    return live.live_histograms(spark, out, 3600, LATENESS)


# index

def build_line_index(spark, sf_dir):
    postings = index.build_line_index(t.documents_as_logs(spark, sf_dir), LINE)
    return postings.select("token", F.col("date").cast("string").alias("date"), "shard", "log_id")


def build_key_index(spark, sf_dir):
    keys = {"k": IndexKey("long"), "value": IndexKey("double")}
    return index.build_key_index(t.events_as_logs(spark, sf_dir), keys).select("log_id", "time", "k", "value")


def lookup_term(spark, sf_dir):
    """Documents and their index are stored, and a word is looked up in a range of days."""
    path, postings = scratch_path(spark, "store"), scratch_path(spark, "index")
    groups = ingest.pack_log_groups(t.documents_as_logs(spark, sf_dir), 50, t.DAY, arrival=F.col("max_time"))
    store.put_logs(groups, path)
    logs = ingest.flatten_log_groups(store.read_groups(spark, path))
    store.write_line_index(index.build_line_index(logs, LINE), postings, t.BUCKETS)
    hits = index.lookup_term(
        store.read_line_index(spark, postings), logs, "The", LINE, t.JAN_1 + 3600, t.JAN_31, t.BUCKETS)
    return hits.select("time", "topic", "source")


def lookup_terms(spark, sf_dir):
    """Documents that hold one of two words but not a third, by their stored index."""
    path, postings = scratch_path(spark, "store"), scratch_path(spark, "index")
    store.put_logs(ingest.pack_log_groups(t.documents_as_logs(spark, sf_dir), 50, t.DAY, arrival=F.col("max_time")), path)
    groups = store.read_groups(spark, path)
    store.write_line_index(index.build_line_index(ingest.flatten_log_groups(groups), LINE), postings, t.BUCKETS)
    hits = index.lookup_terms(
        store.read_line_index(spark, postings), groups, {"a": TERMS[0], "b": TERMS[1], "c": TERMS[2]},
        (F.col("a") | F.col("b")) & ~F.col("c"), LINE, t.JAN_1 + 3600, t.JAN_31, t.BUCKETS)
    return hits.select("time", "topic", "source", F.md5(field("text")).alias("text"))


def lookup_keys(spark, sf_dir):
    """Events by an expression over two numeric keys, by their stored index."""
    path, postings = scratch_path(spark, "store"), scratch_path(spark, "keys")
    store.put_logs(t.event_groups(spark, sf_dir), path)
    groups = store.read_groups(spark, path)
    keys = {"k": IndexKey("long"), "value": IndexKey("double")}
    store.write_key_index(index.build_key_postings(ingest.flatten_log_groups(groups), keys), postings)
    tests = {"dear": index.KeyTest("value", ">", 200.0), "last": index.KeyTest("k", ">=", 90),
             "first": index.KeyTest("k", "<", 5), "cheap": index.KeyTest("value", "<=", 1.0)}
    hits = index.lookup_keys(
        store.read_key_index(spark, postings), groups, keys, tests,
        (F.col("dear") & ~F.col("last")) | (F.col("first") & F.col("cheap")), t.JAN_1 + 3600, t.JAN_31)
    return _values(hits, "time", "topic", "source")


# collect

def read_log_files_query(spark, sf_dir):
    lines = read_log_files(spark, t.write_document_files(spark, sf_dir), "*.txt")
    return lines.groupBy(
        F.regexp_extract("file_path", "/source=([^/]*)/", 1).alias("source"),
        F.regexp_extract("file_path", "/lang=([^/]*)/", 1).alias("lang"),
    ).agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("line")).alias("n_chars"))


def follow_log_files(spark, sf_dir):
    """Log files that a writer appends to and rotates between the steps of a reader, which sees each line once."""
    folder, out, state = (scratch_path(spark, n) for n in ("growing", "lines", "state"))
    steps = 3
    for step in range(steps):
        t.append_events(spark, sf_dir, folder, step, steps, rotate=step == 1)
        runs.start_files(growing.follow_log_files(spark, folder, "*.log*"), out, state).awaitTermination()
    parts = F.split("line", "[|]")
    return spark.read.parquet(out).select(
        parts[0].alias("at"), parts[1].cast("bigint").alias("event_id"), parts[2].alias("event_type"),
        parts[3].cast("double").alias("value"), parts[4].alias("mark"))


def follow_records(spark, sf_dir):
    """Records of two lines in such files, the last one of each step cut: those that have ended and those still open."""
    folder, out, state = (scratch_path(spark, n) for n in ("growing", "records", "state"))
    steps = 3
    for step in range(steps):
        t.append_events(spark, sf_dir, folder, step, steps, rotate=step == 1, two_lines=True)
        records.records_stream(growing.follow_log_files(spark, folder, "*.log*"), "EVENT.*", out, state).awaitTermination()
    parts = F.split("body", "[|]")
    return records.read_records(spark, out).unionByName(records.open_records(spark, out)).select(
        parts[1].cast("bigint").alias("event_id"), F.trim(F.replace(parts[2], F.lit("\n"), F.lit(" "))).alias("event_type"),
        parts[3].cast("double").alias("value"), parts[4].alias("mark"), "part", "n_lines")


def assemble_records(spark, sf_dir):
    return collect.assemble_records(t.document_lines(spark, sf_dir), "[A-Z].*").drop("oversize")


def assemble_bounded_records(spark, sf_dir):
    return collect.assemble_records(t.document_lines(spark, sf_dir), "[A-Z].*", max_lines=2)


def _url_logs(spark, sf_dir):
    return collect.extract_fields(t.pages_as_records(spark, sf_dir), URL_REGEX, URL_KEYS)


def extract_fields(spark, sf_dir):
    return _url_logs(spark, sf_dir).select("page_id", *[field(k).alias(k) for k in URL_KEYS], "reject_reason")


def filter_records(spark, sf_dir):
    kept = collect.filter_records(_url_logs(spark, sf_dir), ("host", "", "lang"), (r".*\.example\.(com|org)", "x", "en|fr"))
    return kept.select("page_id", field("host").alias("host"), field("lang").alias("lang"))


def parse_log_time(spark, sf_dir):
    """Times of orders in several formats, by the order's key; low priority ones carry none."""
    at = F.timestamp_add("SECOND", F.col("o_orderkey") % t.DAY, F.col("o_orderdate"))
    formats = t.written_times(at)
    kind = F.pmod(F.col("o_orderkey"), F.lit(len(formats)))
    logs = t.table(spark, sf_dir, "orders").withColumn("kind", kind)
    parsed = []
    for n, (form, text) in enumerate(formats):
        text = F.when(F.col("o_orderpriority") == "5-LOW", "not a time").otherwise(text)
        own = logs.filter(F.col("kind") == n).select("o_orderkey", make_contents([("at", text)]).alias("contents"))
        parsed.append(collect.parse_log_time(own, "at", form).select("o_orderkey", "time"))
    return reduce(DataFrame.unionByName, parsed)


def derive_topic(spark, sf_dir):
    logs = t.document_paths(spark, sf_dir).withColumn("group_topic", F.concat(F.lit("group-"), F.col("lang")))
    for name, mode in (("by_path", PATH_TOPIC), ("by_none", "none"), ("by_default", "default"), ("by_group", "group_topic")):
        logs = collect.derive_topic(logs, mode).withColumnRenamed("topic", name)
    return logs.select("doc_id", "by_path", "by_none", "by_default", "by_group")


def route_records(spark, sf_dir):
    return routing.route_records(*t.route_inputs(spark, sf_dir)).select(*ROUTED)


def binding_intervals(spark, sf_dir):
    return routing.binding_intervals(t.binding_feed(spark, sf_dir))


def route_records_in_time(spark, sf_dir):
    """Events by what was bound when they happened."""
    records, members, _, configs = t.route_inputs(spark, sf_dir)
    intervals = routing.binding_intervals(t.binding_feed(spark, sf_dir))
    return routing.route_records_in_time(records, members, intervals, configs).select(*ROUTED)


def _collected(spark: SparkSession, path: str) -> DataFrame:
    """What the stores of a collection hold, and what it refused."""
    held = [
        ingest.flatten_log_groups(store.read_groups(spark, store_path(path, c.project, c.logstore))).select(
            F.lit(c.logstore).alias("logstore"), field("doc").alias("doc"), "time", "topic", "source",
            F.md5(field("message")).alias("message"), F.lit(None).cast("string").alias("reject_reason"))
        for c in t.COLLECT_CONFIGS
    ]
    none = lambda name: F.lit(None).cast("string").alias(name)
    refused = spark.read.parquet(rejects_path(path)).select(
        F.col("config_name").alias("logstore"), none("doc"), F.lit(None).cast("bigint").alias("time"), none("topic"),
        "source", F.md5("body").alias("message"), "reject_reason")
    return reduce(DataFrame.unionByName, [*held, refused])


def collect_logs_query(spark, sf_dir):
    """Files of several machines through two configs into their stores."""
    configs = t.configs_below(t.write_document_files(spark, sf_dir))
    lines = read_log_files(spark, configs[0].log_path, "*.txt")
    members, bindings = t.collecting_fleet(spark, sf_dir)
    routes = routes_of(lines, configs, members, bindings, t.machine_of_file())
    path = scratch_path(spark, "collected")
    write_collected(collect_configs(lines, configs, t.machine_of_file(), routes), configs, path, t.PACKING)
    return _collected(spark, path)


def collect_logs_stream(spark, sf_dir):
    """The same from a stream of files, in several batches."""
    configs = t.configs_below(t.write_document_files(spark, sf_dir))
    members, bindings = t.collecting_fleet(spark, sf_dir)
    routes = lambda files: routes_of(files, configs, members, bindings, t.machine_of_file())
    lines = stream_log_files(spark, configs[0].log_path, "*.txt", max_files=60)
    path, state = scratch_path(spark, "collected"), scratch_path(spark, "state")
    collect_stream(lines, configs, path, state, t.machine_of_file(), t.PACKING, routes).awaitTermination()
    return _collected(spark, path)


# fleet

def expand_machine_groups(spark, sf_dir):
    return fleet.expand_machine_groups(t.machine_groups(spark, sf_dir), t.machines(spark, sf_dir))


def machine_totals(spark, sf_dir):
    return fleet.machine_totals(expand_machine_groups(spark, sf_dir))


def applied_configs(spark, sf_dir):
    bindings = t.table(spark, sf_dir, "orders").select(
        F.concat(F.lit("customer-"), F.col("o_custkey").cast("string")).alias("group_name"),
        F.col("o_orderpriority").alias("config_name"),
    )
    return fleet.applied_configs(bindings)


def applied_machine_groups(spark, sf_dir):
    bindings = t.table(spark, sf_dir, "lineitem").select(
        F.concat("l_returnflag", "l_linestatus").alias("config_name"),
        F.concat(F.lit("supplier-"), F.col("l_suppkey").cast("string")).alias("group_name"),
    )
    return fleet.applied_machine_groups(bindings)


def current_bindings(spark, sf_dir):
    changes = t.order_feed(spark, sf_dir).select(
        F.col("o_orderpriority").alias("config_name"), F.col("o_custkey").alias("group_name"),
        F.when(F.col("o_orderstatus") == "F", "remove").otherwise("apply").alias("op"), "position",
    )
    return fleet.current_bindings(changes)


def entity_snapshot(spark, sf_dir):
    op = F.when(F.col("o_orderstatus") == "F", "delete").when(F.col("o_orderstatus") == "O", "create")
    changes = t.order_feed(spark, sf_dir).select(
        F.col("o_custkey").alias("name"), op.otherwise("update").alias("op"),
        seconds(F.col("o_orderdate")).alias("time"), "position", "o_totalprice", "o_orderpriority",
    )
    return fleet.entity_snapshot(changes, ["o_totalprice", "o_orderpriority"])


def follow_entities(spark, sf_dir):
    """The same feed in three steps, by what each step changes."""
    feed, out, state = (scratch_path(spark, n) for n in ("feed", "entities", "state"))
    held = ["o_totalprice", "o_orderpriority"]
    op = F.when(F.col("o_orderstatus") == "F", "delete").when(F.col("o_orderstatus") == "O", "create")
    day = F.unix_date(F.col("o_orderdate").cast("date")).cast("bigint")
    changes = t.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("name"), op.otherwise("update").alias("op"), seconds(F.col("o_orderdate")).alias("time"),
        (F.shiftleft(day, 40) + F.col("o_orderkey")).alias("position"), *held)
    low, high = t.ORDER_DAYS
    for begin, end in [("0001-01-01", low), (low, high), (high, "9999-12-31")]:
        inside = (F.col("time") >= F.unix_seconds(F.lit(begin).cast("timestamp"))) & (
            F.col("time") < F.unix_seconds(F.lit(end).cast("timestamp")))
        changes.filter(inside).write.mode("append").parquet(feed)
        stream = spark.readStream.schema(changes.schema).parquet(feed)
        runs.start_files(entities.entity_changes(stream, held), out, state).awaitTermination()
    return entities.entities_of(spark.read.parquet(out), held)


def missing_targets(spark, sf_dir):
    return fleet.missing_targets(
        t.table(spark, sf_dir, "documents").select("doc_id"), t.table(spark, sf_dir, "labels"), "doc_id"
    )


QUERIES: dict[str, Query] = {
    "pack_log_groups": pack_log_groups,
    "flatten_log_groups": flatten_log_groups,
    "flatten_contents": flatten_contents,
    "assign_shard": assign_shard,
    "put_logs": put_logs,
    "put_logs_stream": put_logs_stream,
    "expire_logs": expire_logs,
    "meter_volume": meter_volume,
    "list_shards": list_shards,
    "resolve_cursor": resolve_cursor,
    "pull_logs": pull_logs,
    "next_cursors": next_cursors,
    "follow_shards": follow_shards,
    "split_shards": split_shards,
    "tail_logs": tail_logs,
    "scan_logs": scan_logs,
    "scan_groups": scan_groups,
    "term_match": term_match_query,
    "key_term_match": key_term_match_query,
    "key_compare": key_compare_query,
    "get_logs": get_logs,
    "get_logs_by_rank": get_logs_by_rank,
    "get_histograms": get_histograms,
    "histogram_total": histogram_total,
    "rollup_histograms": rollup_histograms,
    "live_histograms": live_histograms,
    "build_line_index": build_line_index,
    "build_key_index": build_key_index,
    "lookup_term": lookup_term,
    "lookup_terms": lookup_terms,
    "lookup_keys": lookup_keys,
    "read_log_files": read_log_files_query,
    "follow_log_files": follow_log_files,
    "follow_records": follow_records,
    "assemble_records": assemble_records,
    "assemble_bounded_records": assemble_bounded_records,
    "extract_fields": extract_fields,
    "filter_records": filter_records,
    "parse_log_time": parse_log_time,
    "derive_topic": derive_topic,
    "route_records": route_records,
    "binding_intervals": binding_intervals,
    "route_records_in_time": route_records_in_time,
    "collect_logs": collect_logs_query,
    "collect_logs_stream": collect_logs_stream,
    "expand_machine_groups": expand_machine_groups,
    "machine_totals": machine_totals,
    "applied_configs": applied_configs,
    "applied_machine_groups": applied_machine_groups,
    "current_bindings": current_bindings,
    "entity_snapshot": entity_snapshot,
    "follow_entities": follow_entities,
    "missing_targets": missing_targets,
}
