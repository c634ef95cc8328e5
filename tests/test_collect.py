import random
import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from helpers import logs_frame, tuples
from logloom.model import CollectConfig, IndexKey, IndexLine
from logloom.operators.collect import (
    assemble_records, derive_topic, extract_fields, filter_records, glob_regex, parse_log_time,
)
from logloom.operators.ingest import flatten_log_groups
from logloom.plans.collecting import (
    Packing, accepted, collect_configs, collect_logs, rejected, rejects_path, routes_of, store_path, write_collected,
)
from logloom.sources.files import plain_path, read_log_files
from logloom.sources.store import read_groups

PIECES = "file_path", "record", "part", "n_lines", "body", "oversize"


def lines_frame(spark, files, block):
    rows = [(name, n // block, n, line) for name, lines in files.items() for n, line in enumerate(lines)]
    return spark.createDataFrame(rows, "file_path string, block_start bigint, line_id bigint, line string")


def expected_records(files, begin, max_lines):
    out = []
    for name, lines in files.items():
        record, members = 0, {}
        for line in lines:
            if begin is None or re.fullmatch(begin, line, re.S):
                record += 1
            members.setdefault(record, []).append(line)
        for r, body in members.items():
            size = max_lines or len(body)
            for at in range(0, len(body), size):
                part = body[at:at + size]
                out.append((name, r, at // size, len(part), "\n".join(part), len(body) > size))
    return sorted(out)


def random_files(seed):
    rng = random.Random(seed)
    files = {}
    for f in range(12):
        density = rng.choice([0, 0.02, 0.3, 1])
        files[f"/f{f}"] = [
            ("# " if rng.random() < density else "") + rng.choice(["", "x", "a b", "é", " # no"]) + str(n)
            for n in range(rng.choice([1, 5, 60]))]
    return files


@pytest.mark.parametrize("block", [1, 3, 7, 1000])
@pytest.mark.parametrize("max_lines", [1, 4, None])
def test_records_do_not_depend_on_blocks(spark, block, max_lines):
    files = random_files(block * (max_lines or 9))
    got = assemble_records(lines_frame(spark, files, block), "# .*", max_lines)
    assert tuples(got, *PIECES) == expected_records(files, "# .*", max_lines)


def test_without_a_begin_regex_lines_are_records(spark):
    files = {"/a": ["1", "2", "3"]}
    assert tuples(assemble_records(lines_frame(spark, files, 2), ""), *PIECES) == expected_records(files, None, None)


def test_a_begin_that_never_matches_loses_nothing(spark):
    files = {"/a": [str(n) for n in range(50)]}
    got = tuples(assemble_records(lines_frame(spark, files, 7), "never", 9), *PIECES)
    assert got == expected_records(files, "never", 9)
    assert "\n".join(body for *_, body, _ in got) == "\n".join(files["/a"])


def write_files(folder, files):
    for name, lines in files.items():
        path = folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("\n".join(lines) + "\n", encoding="utf-8")


@pytest.mark.parametrize("split_bytes", ["200", "5000", "128m"])
def test_files_are_read_whole_and_in_order_across_splits(spark, tmp_path, split_bytes):
    rng = random.Random(9)
    files = {f"d{f}/a b+{f}.LOG": [("# " if rng.random() < 0.3 else "") + "é" * rng.randrange(30) + str(n)
                                  for n in range(300)] for f in range(3)}
    write_files(tmp_path, files)
    (tmp_path / "other.txt").write_text("# not collected\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
        lines = read_log_files(spark, str(tmp_path), "*.LOG")
        got = tuples(assemble_records(lines, "# .*", 5), *PIECES)
        if split_bytes == "200":
            assert lines.select("block_start").distinct().count() > 10
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == expected_records({f"{tmp_path}/{name}": l for name, l in files.items()}, "# .*", 5)


def test_paths_lose_scheme_and_escapes(spark):
    uris = ["file:///var/log/a%20b+c.LOG", "hdfs://host:8020/x/y", "/plain", "/100%"]
    frame = spark.createDataFrame([(u,) for u in uris], "u string")
    assert [r.p for r in frame.select(plain_path(F.col("u")).alias("p")).collect()] == ["/var/log/a b+c.LOG", "/x/y", "/plain", "/100%"]


def bodies(spark, *texts):
    return spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, body string")


def test_fields_come_from_a_full_match(spark):
    frame = extract_fields(bodies(spark, "a=1\nb", "a=", "xa=1", None), r"a=([0-9]*)(.*)", ["num", "rest"])
    got = [([tuple(c) for c in r.contents] if r.contents else None, r.reject_reason) for r in frame.orderBy("n").collect()]
    miss = (None, "extraction regex does not match")
    assert got == [([("num", "1"), ("rest", "\nb")], None), ([("num", ""), ("rest", "")], None), miss, miss]


def test_alternatives_are_anchored_as_one(spark):
    frame = extract_fields(bodies(spark, "ab", "abc", "xb"), "(a|ab)|(b|xb)", ["one", "two"])
    assert [r.reject_reason is None for r in frame.orderBy("n").collect()] == [True, False, True]


def test_a_body_with_the_internal_separator(spark):
    frame = extract_fields(bodies(spark, "a\x01b=c", "\x01", "$1=\\2"), "(.*)=(.*)", ["one", "two"])
    got = [[c.value for c in r.contents] if r.contents else None for r in frame.orderBy("n").collect()]
    assert got == [["a\x01b", "c"], None, ["$1", "\\2"]]
    one = extract_fields(bodies(spark, "", "x"), "(y?)", ["one"]).orderBy("n").collect()
    assert [(r.contents and r.contents[0].value, r.reject_reason is None) for r in one] == [("", True), (None, False)]
    many = extract_fields(bodies(spark, "abcdefghijkl"), "(.)" * 12, [f"k{n}" for n in range(12)])
    assert [c.value for c in many.first().contents] == list("abcdefghijkl")


def test_no_regex_is_one_field(spark):
    frame = extract_fields(bodies(spark, "a\nb"), "", ["message"])
    assert [tuple(c) for c in frame.first().contents] == [("message", "a\nb")]
    for regex, keys in (("", ["one", "two"]), ("(a)", ["one", "two"]), ("(a)", [])):
        with pytest.raises(ValueError):
            extract_fields(bodies(spark, "a"), regex, keys)


def test_filters(spark):
    logs = logs_frame(spark, [("1", 0, "t", "s", [("a", "x1"), ("b", "y")]), ("2", 0, "t", "s", [("a", "x1")]),
                              ("3", 0, "t", "s", [("a", "zx1"), ("b", "y")])])
    ids = lambda keys, regexes: [i for i, in tuples(filter_records(logs, keys, regexes), "log_id")]
    assert ids(["a", "b"], ["x.", "y|z"]) == ["1"]
    assert ids(["a"], ["x."]) == ["1", "2"]
    assert ids([""], [""]) == ids([], []) == ["1", "2", "3"]
    with pytest.raises(ValueError):
        filter_records(logs, ["a"], [])


def test_time_needs_a_key_or_an_ingest_time(spark):
    logs = logs_frame(spark, [("1", 0, "t", "s", [("at", "2024/01/01 00:00:00")])]).drop("time")
    assert parse_log_time(logs, "at", "%Y/%m/%d %H:%M:%S").first().time == 1704067200
    assert parse_log_time(logs, "", "", ingest_time=7).first().time == 7
    with pytest.raises(ValueError):
        parse_log_time(logs, "", "")
    with pytest.raises(ValueError):
        parse_log_time(logs, "", "%Y-%m-%d")


@pytest.mark.parametrize("mode, topic", [
    ("/data/apps/([^/]*)/.*", "billing"), ("none", ""), ("", ""), ("group_topic", "the group"),
    ("default", "/data/apps/billing/run-17/worker.LOG"), ("/log/([^/]*)/.*", ""),
])
def test_topics(spark, mode, topic):
    path = "/data/apps/billing/run-17/worker.LOG"
    frame = spark.createDataFrame([(path, "the group")], "file_path string, group_topic string")
    assert derive_topic(frame, mode).first().topic == topic


@pytest.mark.parametrize("glob, name, matches", [
    ("*.LOG", "func1.LOG", True), ("*.LOG", "func1.LOGS", False), ("*.LOG", "func1xLOG", False),
    ("f?nc*", "func1", True), ("a+(b)", "a+(b)", True), ("a+(b)", "aab", False),
])
def test_globs(spark, glob, name, matches):
    frame = spark.createDataFrame([(glob, name)], "g string, n string")
    hit = F.rlike("n", F.concat(F.lit(r"\A"), glob_regex(F.col("g")), F.lit(r"\z")))
    assert frame.select(hit.alias("h")).first().h is matches


def test_collecting_keeps_all_that_fails(spark, tmp_path):
    write_files(tmp_path / "in", {"svc/1.LOG": [
        "junk before", "2024-01-01 00:00:00 INFO one", " more", "2024-13-01 00:00:00 INFO bad month",
        "2024-01-01 00:00:01 DEBUG dropped", "2024-01-01 00:00:02 INFO two", "2", "3", "4", "5"]})
    config = CollectConfig(
        name="c", log_path=str(tmp_path / "in"), file_pattern="*.LOG", log_begin_regex=r"[0-9]{4}-.*",
        regex=r"(\S+ \S+) ([A-Z]+) (.*)", keys=("at", "level", "message"), time_key="at",
        time_format="%Y-%m-%d %H:%M:%S", filter_keys=("level",), filter_regex=("INFO|WARN",),
        topic_format=".*/in/([^/]*)/.*", project="p", logstore="s", max_lines=3)
    lines = read_log_files(spark, config.log_path, config.file_pattern)
    collected = collect_logs(lines, config, F.lit("host"))
    good = accepted(collected).orderBy("time").collect()
    assert [(r.time, r.topic, r.source, r.project, r.logstore, r.contents[2].value) for r in good] == [
        (1704067200, "svc", "host", "p", "s", "one\n more")]
    refused = [
        (0, 0, "junk before", "extraction regex does not match"),
        (2, 0, "2024-13-01 00:00:00 INFO bad month", "time does not parse"),
        (4, 0, "2024-01-01 00:00:02 INFO two\n2\n3", "record has too many lines"),
        (4, 1, "4\n5", "record has too many lines")]
    assert tuples(rejected(collected), "record", "part", "body", "reject_reason") == refused
    write_collected(collected, [config], str(tmp_path / "out"), Packing(2, arrival=1))
    stored = read_groups(spark, store_path(str(tmp_path / "out"), "p", "s"))
    assert tuples(flatten_log_groups(stored), "time", "topic", "source") == [(1704067200, "svc", "host")]
    assert tuples(spark.read.parquet(rejects_path(str(tmp_path / "out"))), "record", "part", "body", "reject_reason") == refused
    whole = collect_logs(lines, replace(config, max_lines=None), F.lit("host"))
    assert [r.contents[2].value for r in accepted(whole).orderBy("time").collect()] == ["one\n more", "two\n2\n3\n4\n5"]


def test_the_same_path_of_several_machines(spark, tmp_path):
    for machine in ("a", "b"):
        write_files(tmp_path / "in" / machine, {"var/app.LOG": ["one", "two"]})
    config = CollectConfig(name="c", log_path="", regex="(.*)", keys=("m",), project="p", logstore="s")
    source = F.regexp_extract("file_path", "/in/([^/]*)/", 1)
    collected = collect_logs(read_log_files(spark, str(tmp_path / "in"), "*.LOG"), config, source, ingest_time=7)
    assert tuples(collected, "source") == [("a",), ("a",), ("b",), ("b",)]
    assert collected.select("log_id").distinct().count() == 4


def test_files_with_carriage_returns(spark, tmp_path):
    (tmp_path / "x.LOG").write_bytes(b"2024-01-01\r\n2024-01-02\r\n")
    config = CollectConfig(name="c", log_path=str(tmp_path), regex="(.*)", keys=("at",), time_key="at", time_format="%Y-%m-%d",
                           project="p", logstore="s", line_sep="\r\n")
    collected = collect_logs(read_log_files(spark, config.log_path, "*.LOG", config.line_sep), config, F.lit("h"))
    assert tuples(collected, "time", "reject_reason") == [(1704067200, None), (1704153600, None)]


def test_a_destination_is_needed(spark, tmp_path):
    config = CollectConfig(name="c", log_path="", regex="(.*)", keys=("m",))
    lines = lines_frame(spark, {"/a": ["1"]}, 2)
    with pytest.raises(ValueError, match="project or logstore"):
        write_collected(collect_logs(lines, config, F.lit("h"), 7), [config], str(tmp_path), Packing(1))
    with pytest.raises(ValueError, match="name"):
        CollectConfig(name="", log_path="")
    with pytest.raises(ValueError, match="delimiter"):
        IndexKey(token=("",))
    with pytest.raises(ValueError, match="delimiter"):
        IndexLine(token=(" ", ""))


def test_configs_take_the_files_routed_to_them(spark):
    lines = lines_frame(spark, {"/m1/a/x.LOG": ["1"], "/m1/b/y.txt": ["2"], "/m2/a/x.LOG": ["3"]}, 2)
    source = F.regexp_extract("file_path", "^/([^/]*)/", 1)
    configs = [CollectConfig(n, path, pattern, regex="(.*)", keys=("m",), project="p", logstore=n)
               for n, path, pattern in (("logs", "/", "*.LOG"), ("all", "/m1", "*"))]
    configs = [replace(c, log_path=p) for c, p in zip(configs, ("/m1", "/m1"))] + [replace(configs[0], name="two", log_path="/m2/a")]
    members = spark.createDataFrame([("g", "m1", ""), ("h", "m2", "")], "group_name string, machine_id string, group_topic string")
    bindings = spark.createDataFrame([("logs", "g"), ("all", "g"), ("two", "h"), ("all", "h")], "config_name string, group_name string")
    got = collect_configs(lines, configs, source, routes_of(lines, configs, members, bindings, source), ingest_time=7)
    assert tuples(got, "config_name", "file_path") == [
        ("all", "/m1/a/x.LOG"), ("all", "/m1/b/y.txt"), ("logs", "/m1/a/x.LOG"), ("two", "/m2/a/x.LOG")]


def test_configs_that_read_alike_share_a_pass(spark, tmp_path):
    """Each gets what it collects alone, rejects too, and the lines are read as often as for one config."""
    for machine in ("m1", "m2"):
        (tmp_path / machine / "de").mkdir(parents=True)
        (tmp_path / machine / "de" / "x.LOG").write_text("".join(f"# {n} {'ab'[n % 2]}\n more\n" for n in range(9)) + "# none\n")
    base = CollectConfig("a", str(tmp_path), "*.LOG", "#.*", "# ([0-9]+) (.*)", ("n", "kind"), project="p", logstore="a",
                         filter_keys=("kind",), filter_regex=("a.*",), topic_format=".*/([^/]*)/x.LOG")
    configs = [base, replace(base, name="b", filter_regex=("b.*",), topic_format="default", logstore="b"),
               replace(base, name="c", filter_keys=(), filter_regex=(), project="q"), replace(base, name="d", max_lines=1)]
    lines, source = read_log_files(spark, str(tmp_path), "*.LOG"), F.regexp_extract("file_path", "/(m.)/", 1)
    both = collect_configs(lines, configs, source, ingest_time=7)
    columns = [c for c in both.columns if c != "contents"] + [F.to_json("contents")]
    alone = [collect_logs(lines, c, source, ingest_time=7).select(*columns).collect() for c in configs]
    order = lambda rows: sorted(map(str, rows))
    assert order(both.select(*columns).collect()) == order(r for rows in alone for r in rows)
    assert [len(rows) for rows in alone] == [12, 10, 20, 38]
    scans = lambda frame: frame._jdf.queryExecution().optimizedPlan().toString().count("Relation [value")
    routes = spark.createDataFrame([(f"{tmp_path}/m1/de/x.LOG", c.name) for c in configs[:2]], "file_path string, config_name string")
    routed = collect_configs(lines, configs[:3], source, routes, ingest_time=7)
    assert scans(collect_configs(lines, configs[:3], source, ingest_time=7)) == scans(routed) == scans(
        collect_logs(lines, base, source, ingest_time=7))
    assert order(routed.select(*columns).collect()) == order(
        r for rows in alone[:2] for r in rows if r["source"] == "m1")
    write_collected(both, configs, str(tmp_path / "out"), Packing(1))
    stored = lambda *of: read_groups(spark, store_path(str(tmp_path / "out"), *of)).agg(F.sum("n_logs")).first()[0]
    assert [stored("p", "a"), stored("p", "b"), stored("q", "a")] == [10, 8, 18]
    assert spark.read.parquet(rejects_path(str(tmp_path / "out"))).count() == 6 + 38
