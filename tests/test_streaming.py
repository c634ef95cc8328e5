import pytest
from pyspark.sql import functions as F

from helpers import GROUP_COLUMNS, LOG_COLUMNS, groups_frame, tuples
from logloom.model import CollectConfig
from logloom.operators.ingest import flatten_log_groups, pack_log_groups
from logloom.operators.search import get_histograms
from logloom.plans.collecting import Packing, collect_configs, rejects_path, store_path, write_collected
from logloom.plans.scratch import scratch_path
from logloom.sources.files import number_lines, read_log_files, stream_log_files
from logloom.sources.store import drop_expired, put_logs, read_groups
from logloom.streaming.collecting import collect_stream
from logloom.streaming.live import count_stream, live_histograms
from logloom.streaming.runs import start_batches, start_files
from logloom.streaming.store import put_logs_stream, tail_logs


def packed(spark, first, last):
    rows = [(f"{i:04d}", i * 600, "t", f"s{i % 3}", None, [("i", str(i))], i % 2) for i in range(first, last)]
    return pack_log_groups(spark.createDataFrame(rows, LOG_COLUMNS), 4, 3600, 10**6)


def test_tailing_resumes_where_it_stopped(spark, tmp_path):
    store, out, state = (str(tmp_path / n) for n in ("store", "out", "state"))
    put_logs(packed(spark, 0, 100), store)
    follow = lambda: start_files(
        tail_logs(spark, store, max_files=1, start_time=6000), out, state).awaitTermination()
    follow()
    assert tuples(spark.read.parquet(out), "time") == [(i * 600,) for i in range(10, 100)]
    follow()
    put_logs(packed(spark, 100, 130), store)
    follow()
    assert tuples(spark.read.parquet(out), "time") == [(i * 600,) for i in range(10, 130)]


def test_groups_are_stored_from_a_stream(spark, tmp_path):
    arrived, store, state = (str(tmp_path / n) for n in ("arrived", "store", "state"))
    frame = groups_frame(spark, [("t", "s", None, [(86399, [("k", "1")]), (86400, [("k", "2")])]), ("t", "s", None, [])])
    frame.write.parquet(arrived)
    stream = spark.readStream.schema(GROUP_COLUMNS).parquet(arrived)
    put_logs_stream(stream, store, state).awaitTermination()
    put_logs_stream(stream, store, state).awaitTermination()
    assert [(str(d), n) for d, n in tuples(read_groups(spark, store), "date", "n_logs")] == [("1970-01-01", 1), ("1970-01-02", 1)]
    groups_frame(spark, [("t", "s", None, [(5, [("k", None)])])]).write.mode("append").parquet(arrived)
    with pytest.raises(Exception, match="content without key or value"):
        put_logs_stream(stream, store, state).awaitTermination()
    rejects = str(tmp_path / "rejects")
    put_logs_stream(stream, store, state, rejects).awaitTermination()
    assert tuples(spark.read.parquet(rejects), "reject_reason") == [("content without key or value",)]
    assert read_groups(spark, store).count() == 2
    # what a stream has stored can be followed by another one
    out = str(tmp_path / "out")
    start_files(tail_logs(spark, store), out, str(tmp_path / "tail")).awaitTermination()
    assert tuples(spark.read.parquet(out), "time") == [(86399,), (86400,)]


def test_a_path_has_one_kind_of_writer(spark, tmp_path):
    arrived, by_stream, by_batch = (str(tmp_path / n) for n in ("arrived", "stream", "batch"))
    groups = groups_frame(spark, [("t", "s", None, [(5, [("k", "1")])])])
    groups.write.parquet(arrived)
    stream = spark.readStream.schema(GROUP_COLUMNS).parquet(arrived)
    put_logs(groups, by_batch)
    put_logs_stream(stream, by_stream, str(tmp_path / "state")).awaitTermination()
    with pytest.raises(ValueError):
        put_logs(groups, by_stream)
    with pytest.raises(ValueError):
        put_logs_stream(stream, by_batch, str(tmp_path / "state2"))
    assert drop_expired(spark, by_stream, 1, 10**9) == drop_expired(spark, by_batch, 1, 10**9) == ["1970-01-01"]


def test_a_stream_runs_until_it_is_stopped(spark, tmp_path):
    arrived, store = str(tmp_path / "arrived"), str(tmp_path / "store")
    groups = groups_frame(spark, [("t", "s", None, [(5, [("k", "1")])])])
    groups.write.parquet(arrived)
    stream = spark.readStream.schema(GROUP_COLUMNS).parquet(arrived)
    query = put_logs_stream(stream, store, str(tmp_path / "state"), trigger={"processingTime": "1 second"})
    try:
        query.processAllAvailable()
        assert query.isActive and read_groups(spark, store).count() == 1
        groups.write.mode("append").parquet(arrived)
        query.processAllAvailable()
        assert read_groups(spark, store).count() == 2
    finally:
        query.stop()


@pytest.fixture
def times(spark, tmp_path):
    path = str(tmp_path / "times")
    spark.range(1000).select((F.col("id") * 37).alias("time")).repartition(3).write.parquet(path)
    return spark.readStream.schema("time bigint").parquet(path)


@pytest.mark.parametrize("origin", [0, 5000])
def test_counts_of_batches_are_the_histogram(spark, times, tmp_path, origin):
    out = str(tmp_path / "out")
    count_stream(times, out, str(tmp_path / "state"), 3600, origin).awaitTermination()
    got = live_histograms(spark, out, 3600, 600)
    every = list(range(0, 37000, 37))
    expected = {}
    for t in every:
        if t >= origin:
            start = t - (t - origin) % 3600
            expected[start] = expected.get(start, 0) + 1
    assert tuples(got, "from", "to", "count") == sorted((s, s + 3600, n) for s, n in expected.items())
    assert {f for f, in tuples(got.filter("progress = 'Incomplete'"), "from")} == {s for s in expected if s + 3600 > every[-1] - 600}


def test_late_logs_count(spark, tmp_path):
    path, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for first in (90_000, 0, 45_000):
        spark.range(first, first + 1000).select(F.col("id").alias("time")).write.mode("append").parquet(path)
        count_stream(spark.readStream.schema("time bigint").parquet(path), out, state, 3600).awaitTermination()
    got = live_histograms(spark, out, 3600, 600)
    logs = spark.read.parquet(path).withColumns({"log_id": F.col("time").cast("string"), "topic": F.lit("")})
    whole = get_histograms(logs, "", 0, 25 * 3600 + 3600, None, 3600).filter("count > 0")
    assert tuples(got, "from", "to", "count") == tuples(whole, "from", "to", "count")


CONFIG = CollectConfig(name="c", log_path="", file_pattern="*.LOG", log_begin_regex="# .*", regex="# ([0-9]+) (.*)",
                       keys=("n", "text"), project="p", logstore="s")


def write_log(folder, name, first, last):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(f"# {n} head\n second\n third {n}\n" for n in range(first, last)))


PACKING = Packing(2, max_logs=7, arrival=5)


def host():
    return F.lit("host")


def contents(spark, path):
    return tuples(flatten_log_groups(read_groups(spark, store_path(path, "p", "s"))), "time", "topic", "source", "contents")


def test_files_are_collected_as_they_appear(spark, tmp_path):
    folder, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    lines = lambda: stream_log_files(spark, str(folder), "*.LOG", max_files=1)
    collect = lambda state: collect_stream(lines(), [CONFIG], out, state, host(), PACKING, ingest_time=7).awaitTermination()
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
        for name, first, last in (("a.LOG", 0, 100), ("b.LOG", 100, 150), ("c.LOG", 150, 300)):
            write_log(folder, name, first, last)
            collect(state)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    streamed = contents(spark, out)
    collected = collect_configs(read_log_files(spark, str(folder), "*.LOG"), [CONFIG], host(), ingest_time=7)
    write_collected(collected, [CONFIG], str(tmp_path / "batch"), PACKING)
    assert streamed == contents(spark, str(tmp_path / "batch")) and len(streamed) == 300
    assert {c[1].value for *_, c in streamed} == {f"head\n second\n third {n}" for n in range(300)}
    collect(str(tmp_path / "another state"))  # another stream adds, it does not overwrite
    assert len(contents(spark, out)) == 600


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    write_log(folder, "a.LOG", 0, 10)
    (folder / "b.LOG").write_text("# not a number\n")
    lines = read_log_files(spark, str(folder), "*.LOG").drop("line_id")
    for _ in range(2):
        collected = collect_configs(number_lines(lines), [CONFIG], host(), ingest_time=7)
        write_collected(collected, [CONFIG], out, PACKING, folder="run=a/batch=0")
    assert len(contents(spark, out)) == 10
    assert spark.read.parquet(rejects_path(out)).count() == 1


def test_a_batch_has_a_folder_of_its_own(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.range(10).repartition(2).write.parquet(path)
    seen = []
    for state in ("a", "a", "b"):
        stream = spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 1).parquet(path)
        start_batches(stream, lambda batch, folder: seen.append(folder), str(tmp_path / state)).awaitTermination()
    assert len(set(seen)) == len(seen) == 4 and len({f.split("/")[0] for f in seen}) == 2


def test_scratch_is_the_shared_folder_of_the_session(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir") + "/x-")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_a_batch_routes_its_own_files_only(spark, tmp_path):
    folder, seen = tmp_path / "in", []
    for name, first, last in (("a.LOG", 0, 5), ("b.LOG", 5, 8), ("c.LOG", 8, 20)):
        write_log(folder, name, first, last)

    def routes(lines):
        files = lines.select("file_path").distinct().filter("file_path not like '%b.LOG'")
        seen.append([r["file_path"].split("/")[-1] for r in lines.select("file_path").distinct().collect()])
        return files.select("file_path", F.lit("c").alias("config_name"))

    lines = stream_log_files(spark, str(folder), "*.LOG", max_files=1)
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    collect_stream(lines, [CONFIG], out, state, host(), PACKING, routes, ingest_time=7).awaitTermination()
    assert sorted(seen) == [["a.LOG"], ["b.LOG"], ["c.LOG"]]
    assert len(contents(spark, out)) == 5 + 12
