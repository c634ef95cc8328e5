import datetime as dt
import random
import time
from hashlib import md5
from itertools import groupby
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from helpers import LOG_COLUMNS, groups_frame, logs_frame, tuples
from logloom.functions.sizes import group_size, list_size, log_size, varint_size
from logloom.model import GROUPS_SCHEMA
from logloom.operators.ingest import (
    assign_shard, check_groups, expire_logs, flatten_contents, flatten_log_groups, meter_volume, pack_log_groups,
)
from logloom.plans.skew import Heat
from logloom.sources.store import drop_expired, put_logs, read_groups

DAY = 86_400


def test_known_sizes(spark):
    """The sizes of one recorded group: content 22, log 30, group 50, list 52."""
    frame = groups_frame(spark, [("", "192.0.2.1:80001"[:14], None, [(1700000000, [("a" * 7, "b" * 11)])])])
    row = frame.withColumn("group", group_size("logs", "reserved", "topic", "source")).select(
        log_size("logs[0].time", "logs[0].contents").alias("log"), "group", list_size("group").alias("list"),
        group_size("logs", "reserved", "cast(null as string)", "source").alias("no_topic"),
    ).first()
    assert (row["log"], row["group"], row["list"], row["no_topic"]) == (30, 50, 52, 48)


def test_varint_size(spark):
    numbers = [0, 1, 127, 128, 16383, 16384, 2**28 - 1, 2**28, 2**32 - 1, 2**56]
    frame = spark.createDataFrame([(n,) for n in numbers], "n bigint")
    got = [r.s for r in frame.select(varint_size("n").alias("s")).collect()]
    assert got == [max(1, -(-n.bit_length() // 7)) for n in numbers]


def some_logs(spark, n, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = "hot" if rng.random() < 0.6 else f"s{rng.randrange(20)}"
        topic = rng.choice([None, "", "a", "b"])
        rows.append((f"{i:06d}", DAY + rng.randrange(4) * 1800 + rng.choice([0, 0, 5, 9]), topic, source, None,
                     [("i", str(i))], rng.randrange(2)))
    return spark.createDataFrame(rows, LOG_COLUMNS), rows


def ranked(log_id):
    """The order of logs of one second."""
    return md5(log_id.encode()).hexdigest()


def packed_ids(groups):
    return [
        (r.shard, r.topic, r.source, [(l.time, l.contents[0].value.zfill(6)) for l in r.logs], r)
        for r in groups.collect()
    ]


def test_groups_fill_up_in_order(spark):
    logs, rows = some_logs(spark, 500)
    got = packed_ids(pack_log_groups(logs, 7, 3600))
    key = lambda r: (r[6], str(r[2]), r[3], r[1] // 3600)
    expected = []
    for (shard, _, source, _), members in groupby(sorted(rows, key=lambda r: (key(r), r[1], ranked(r[0]))), key=key):
        members = list(members)
        for at in range(0, len(members), 7):
            expected.append((shard, str(members[at][2]), source, [(m[1], m[0]) for m in members[at:at + 7]]))
    assert sorted((s, str(t), so, l) for s, t, so, l, _ in got) == sorted(expected)


@pytest.mark.parametrize("max_logs", [7, 1])
def test_groups_are_the_same_however_hot_a_window(spark, max_logs):
    logs, rows = some_logs(spark, 2000)
    groups = pack_log_groups(logs, max_logs, 3600, F.col("max_time") + 5)
    got = packed_ids(groups)
    assert sorted(i for *_, members, _ in got for _, i in members) == sorted(r[0] for r in rows)
    source = {r[0]: (r[6], r[2], r[3]) for r in rows}
    for shard, topic, origin, members, row in got:
        assert 1 <= len(members) <= max_logs
        assert members == sorted(members, key=lambda m: (m[0], ranked(m[1])))
        assert {source[i] for _, i in members} == {(shard, topic, origin)}
        assert len({t // 3600 for t, _ in members}) == 1
        assert (row.n_logs, row.min_time, row.max_time) == (len(members), members[0][0], members[-1][0])
        assert row.cursor.startswith(f"{row.max_time + 5:010d}-")
    assert len({row.cursor for *_, row in got}) == len(got)
    hot = pack_log_groups(logs, max_logs, 3600, F.col("max_time") + 5, Heat(max_keys=50, min_rows=10))
    assert sorted(map(str, hot.collect())) == sorted(map(str, groups.collect()))


def test_cursors_tell_groups_apart(spark):
    """The same log id from three sources, topics and reserved fields, in one shard and second."""
    rows = [("1", 5, topic, source, reserved, [], 0)
            for topic in ("a", None) for source in ("x", "y", "x/y") for reserved in ("r", None)]
    groups = pack_log_groups(spark.createDataFrame(rows, LOG_COLUMNS), 10, 60, 1000)
    assert groups.select("cursor").distinct().count() == len(rows)
    assert "cursor" not in pack_log_groups(spark.createDataFrame(rows, LOG_COLUMNS), 10, 60).columns


def test_flattening_undoes_packing(spark):
    logs, rows = some_logs(spark, 300)
    flat = flatten_log_groups(pack_log_groups(logs, 5, 3600, 10**6))
    columns = ["time", "topic", "source", "reserved", "contents", "shard"]
    assert sorted(map(str, flat.select(columns).collect())) == sorted(map(str, logs.select(columns).collect()))
    assert flat.select("log_id").distinct().count() == len(rows)
    assert flatten_contents(flat).count() == len(rows)


def test_shards_are_stable_and_spread(spark):
    frame = spark.createDataFrame([(f"s{i}",) for i in range(200)] + [(None,)], "source string")
    first = tuples(assign_shard(frame, 4).na.fill("-"), "source", "shard")
    assert first == tuples(assign_shard(frame.repartition(3), 4).na.fill("-"), "source", "shard")
    assert {s for _, s in first} == {0, 1, 2, 3}


def test_an_empty_group_writes_nothing(spark, tmp_path):
    put_logs(groups_frame(spark, [("test", "192.0.2.2", None, [])]), str(tmp_path / "s"))
    assert read_groups(spark, str(tmp_path / "s")).count() == 0


INVALID = [
    ("t", "s", None, [(None, [("k", "v")])]),
    ("t", "s", None, [(5, [("k", None)])]),
    ("t", "s", None, [(5, [(None, "v")])]),
    ("t", "s", None, [(2**32, [("k", "v")])]),
]


def test_invalid_groups_are_rejected_with_a_reason(spark, tmp_path):
    store, rejects = str(tmp_path / "s"), str(tmp_path / "r")
    valid = ("t", "s", None, [(2**32 - 1, [("k", "")]), (2**32 - 2, [])])
    none = groups_frame(spark, [valid]).withColumn("logs", F.lit(None).cast(groups_frame(spark, [valid]).schema["logs"].dataType))
    groups = groups_frame(spark, [valid, *INVALID]).unionAll(none)
    put_logs(groups, store, rejects)
    assert tuples(read_groups(spark, store), "n_logs", "max_time") == [(2, 2**32 - 1)]
    reasons = [r.reject_reason for r in spark.read.parquet(rejects).collect()]
    assert sorted(reasons) == sorted(
        ["log without time", "content without key or value", "content without key or value", "group without logs", "time out of range"])
    assert check_groups(groups).filter("reject_reason is null").count() == 1


def test_without_a_place_for_rejects_the_write_fails(spark, tmp_path):
    with pytest.raises(Exception, match="content without key or value"):
        put_logs(groups_frame(spark, INVALID[1:2]), str(tmp_path / "s"))


def test_groups_are_cut_at_midnight(spark, tmp_path):
    store = str(tmp_path / "s")
    raw = groups_frame(spark, [("t", "s", None, [(DAY - 1, [("k", "1")]), (DAY, [("k", "2")]), (DAY + 1, [("k", "3")])])])
    put_logs(raw, store)
    put_logs(raw, store)
    got = read_groups(spark, store)
    assert [(str(r.date), r.n_logs) for r in got.orderBy("date").collect()] == \
        [("1970-01-01", 1), ("1970-01-01", 1), ("1970-01-02", 2), ("1970-01-02", 2)]
    assert got.select("cursor").distinct().count() == 4


def test_stored_cursors_are_kept(spark, tmp_path):
    logs, _ = some_logs(spark, 200)
    packed = pack_log_groups(logs, 5, 3600, 10**6)
    put_logs(packed, str(tmp_path / "s"))
    assert tuples(read_groups(spark, str(tmp_path / "s")), "cursor", "n_logs", "raw_size") == \
        tuples(packed, "cursor", "n_logs", "raw_size")
    put_logs(packed, str(tmp_path / "later"), arrival=2 * 10**6)
    later = [c for c, in tuples(read_groups(spark, str(tmp_path / "later")), "cursor")]
    assert len(set(later)) == packed.count() and all(c.startswith("0002000000-00000001") and len(c) == 43 for c in later)
    put_logs(pack_log_groups(logs, 5, 3600), str(tmp_path / "now"))
    first = read_groups(spark, str(tmp_path / "now")).agg(F.min("cursor")).first()[0]
    assert abs(int(first[:10]) - time.time()) < 600


def test_unknown_columns_are_kept(spark, tmp_path):
    store = str(tmp_path / "s")
    plain = groups_frame(spark, [("t", "s", None, [(5, [("k", "1")])])])
    put_logs(plain, store)
    put_logs(plain.withColumn("origin", F.lit("new")), store)
    assert read_groups(spark, store).columns == GROUPS_SCHEMA.names
    extra = StructType([StructField("origin", StringType())])
    assert {r.origin for r in read_groups(spark, store, extra).collect()} == {None, "new"}


def test_retention(spark, tmp_path):
    logs = logs_frame(spark, [(str(d), d * DAY + 100, "t", "s", []) for d in range(10)])
    as_of = 10 * DAY
    assert tuples(expire_logs(logs, 3, as_of), "log_id") == [("7",), ("8",), ("9",)]
    assert tuples(expire_logs(logs, 3, as_of, index_ttl=1), "log_id") == [("9",)]
    assert tuples(expire_logs(logs, 3, as_of + 101), "log_id") == [("8",), ("9",)]
    store = str(tmp_path / "s")
    put_logs(pack_log_groups(logs, 5, 3600), store)
    assert drop_expired(spark, store, 3, as_of + 101) == [f"1970-01-0{d}" for d in range(1, 8)]
    assert read_groups(spark, store).count() == 3
    assert sorted(p.name for p in Path(store).glob("date=*")) == [
        f"date={dt.date(1970, 1, 1) + dt.timedelta(days=d)}" for d in (7, 8, 9)]


def test_volume(spark):
    logs, rows = some_logs(spark, 100)
    groups = pack_log_groups(logs, 5, 3600)
    total = meter_volume(groups, ["topic"]).agg(F.sum("n_logs"), F.sum("bytes")).first()
    assert total[0] == 100
    assert total[1] == groups.agg(F.sum("raw_size")).first()[0]


def test_a_hot_shard_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(40_000).select(
        F.lit("t").alias("topic"), F.lit("s").alias("source"), F.lit(None).cast("string").alias("reserved"),
        F.array(F.struct((F.lit(DAY) + F.col("id") % 60).alias("time"), F.array(
            F.struct(F.lit("k").alias("key"), F.sha2(F.col("id").cast("string"), 512).alias("value"))).alias("contents"))
        ).alias("logs"), F.lit(0).alias("shard")).repartition(16)
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "500k")
        put_logs(rows, str(tmp_path / "s"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    assert len(list((tmp_path / "s" / "date=1970-01-02" / "shard=0").glob("*.parquet"))) > 3
    assert read_groups(spark, str(tmp_path / "s")).select("cursor").distinct().count() == 40_000
