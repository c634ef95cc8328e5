import random

import pytest
from pyspark.sql import functions as F

from helpers import groups_frame, logs_frame, tuples
from logloom.functions.fields import key_compare, key_term_match, term_match
from logloom.model import Index, IndexKey, IndexLine
from logloom.operators.index import (
    KeyTest, build_index, build_key_index, build_key_postings, build_line_index, lookup_keys, lookup_term, lookup_terms,
)
from logloom.operators.ingest import flatten_log_groups, pack_log_groups
from logloom.operators import search
from logloom.operators.search import (
    find_logs, get_histograms, get_logs, get_logs_by_rank, histogram_total, scan_groups, scan_logs,
)
from logloom.sources.store import (
    put_logs, read_groups, read_key_index, read_line_index, write_key_index, write_line_index,
)

LINE = IndexLine((",", ":", " "))
BEGIN = 1_700_000_000


def plan_of(frame):
    spark = frame.sparkSession
    before = spark.conf.get("spark.sql.maxMetadataStringLength")
    try:
        spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
        return frame._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", before)


@pytest.fixture(scope="module")
def logs(spark):
    """Ten batches of numbered values, some logs in the same second."""
    rng = random.Random(5)
    rows = []
    for i in range(400):
        contents = [("amount", str(rng.randrange(10_000_000)))] + [
            (f"note_{c}", f"round {i // 40}, place {i % 40}, note {c}") for c in range(1, 4)]
        rows.append((f"{i:06d}", BEGIN + rng.randrange(100), "" if i % 3 else "billing", "192.0.2.7", contents))
    return logs_frame(spark, rows).cache()


def test_one_stored_record_is_found_by_word(spark, tmp_path):
    """A log written with a topic is found by a search over any topic: histogram 1, search 1."""
    path = str(tmp_path / "s")
    put_logs(groups_frame(spark, [
        ("billing", "192.0.2.7", None, [(BEGIN, [("reason", "DiskFull")])])]), path)
    stored = flatten_log_groups(read_groups(spark, path))
    word = term_match("DiskFull", LINE)
    assert histogram_total(get_histograms(stored, "", BEGIN, BEGIN + 2, word)).first()["count"] == 1
    page = get_logs(stored, "", BEGIN, BEGIN + 2, word, lines=100, offset=0).collect()
    assert [r.fields for r in page] == [{"reason": "DiskFull"}]
    assert get_logs(stored, "other", BEGIN, BEGIN + 2, word).count() == 0
    assert get_logs(stored, "", BEGIN + 1, BEGIN + 2, word).count() == 0
    assert get_logs(stored, "", BEGIN - 1, BEGIN, word).count() == 0


def test_pages_are_the_whole_result(logs):
    wanted = key_compare("amount", ">", 1_000_000)
    total = histogram_total(get_histograms(logs, "", BEGIN, BEGIN + 100, wanted, 7)).first()["count"]
    pages, offset = [], 0
    while offset < total:
        page = get_logs(logs, "", BEGIN, BEGIN + 100, wanted, lines=100, offset=offset).collect()
        pages += [(r.time, r.log_id) for r in page]
        offset += len(page)
    everything = tuples(find_logs(logs, BEGIN, BEGIN + 100, "", wanted), "time", "log_id")
    assert pages == everything and len(everything) == total


@pytest.mark.parametrize("reverse", [False, True])
def test_pages_after_a_position(logs, reverse):
    pages, after = [], None
    while True:
        page = get_logs(logs, "billing", BEGIN, BEGIN + 90, lines=37, reverse=reverse, after=after).collect()
        if not page:
            break
        pages += [(r.time, r.log_id) for r in page]
        after = pages[-1]
    assert pages == sorted(tuples(scan_logs(logs, BEGIN, BEGIN + 90, "billing"), "time", "log_id"), reverse=reverse)


def test_histogram_buckets(logs):
    """Buckets start at `from`, the last is cut at `to`, empty ones are there, the sum is the count."""
    wanted = key_compare("amount", "<", 100_000)
    start, end = BEGIN + 3, BEGIN + 98
    buckets = sorted(get_histograms(logs, "", start, end, wanted, 10).collect())
    assert [(r["from"], r["to"]) for r in buckets] == [(s, min(s + 10, end)) for s in range(start, end, 10)]
    times = [r.time for r in find_logs(logs, start, end, "", wanted).collect()]
    assert [r["count"] for r in buckets] == [sum(r["from"] <= t < r["to"] for t in times) for r in buckets]
    assert any(r["count"] == 0 for r in buckets) and {r.progress for r in buckets} == {"Complete"}


def test_no_hits_at_all(logs):
    empty = get_histograms(logs, "nothing", BEGIN, BEGIN + 10, None, 5)
    assert [r["count"] for r in empty.collect()] == [0, 0]
    assert tuple(histogram_total(empty).first()) == (0, "Complete")


def test_a_stored_scan_skips_days(spark, tmp_path):
    path = str(tmp_path / "s")
    put_logs(groups_frame(spark, [("t", "s", None, [(d * 86400 + 5, [("k", "v")])]) for d in range(4)]), path)
    stored = flatten_log_groups(read_groups(spark, path))
    near = plan_of(scan_groups(read_groups(spark, path), 86400 + 3, 86400 + 9, "t"))
    assert "GreaterThanOrEqual(max_time," in near and "LessThan(min_time," in near and "EqualTo(topic,t)" in near
    assert scan_groups(read_groups(spark, path), 86400 + 3, 86400 + 9, "t").count() == 1
    assert scan_groups(read_groups(spark, path), 86400 + 6, 86400 + 9).count() == 0
    hits = scan_logs(stored, 86400, 2 * 86400)
    plan = hits._jdf.queryExecution().toString()
    assert "date#" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert hits.count() == 1


def test_lookup_finds_what_the_scan_finds(spark, logs, tmp_path):
    path = str(tmp_path / "index")
    write_line_index(build_line_index(logs, LINE), path, 8)
    for term in ("place", "PLACE", "7", "39", "absent"):
        scanned = tuples(logs.filter(term_match(term, LINE)), "log_id")
        assert tuples(lookup_term(build_line_index(logs, LINE), logs, term, LINE), "log_id") == scanned
        stored = lookup_term(read_line_index(spark, path), logs, term, LINE, buckets=8)
        assert tuples(stored, "log_id") == scanned
        assert "bucket#" in stored._jdf.queryExecution().toString().split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert len(tuples(logs.filter(term_match("place", LINE)), "log_id")) == 400


def test_the_line_index_needs_no_shuffle(logs):
    assert "Exchange" not in build_line_index(logs, LINE)._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0]


def test_key_columns(spark):
    logs = logs_frame(spark, [("1", 5, "t", "s", [("n", "7"), ("d", "1.5"), ("w", "A b")]),
                              ("2", 6, "t", "s", [("n", "7.5"), ("d", "x")])])
    keys = {"n": IndexKey("long"), "d": IndexKey("double"), "w": IndexKey("text", (" ",))}
    got = sorted(build_key_index(logs, keys).select("log_id", "n", "d", "w").collect())
    assert [tuple(r) for r in got] == [("1", 7, 1.5, ["a", "b"]), ("2", None, None, None)]


def test_an_index_covers_its_own_retention(spark):
    logs = logs_frame(spark, [(str(d), d * 86400, "t", "s", [("n", str(d)), ("w", "x y")]) for d in range(10)])
    postings, columns = build_index(logs, Index(3, {"n": IndexKey("long")}, LINE), 10 * 86400)
    assert tuples(columns, "n") == [(7,), (8,), (9,)]
    assert tuples(postings.filter("token = 'y'"), "log_id") == [("7",), ("8",), ("9",)]
    assert build_index(logs, Index(3), 10 * 86400)[0] is None


def test_times_beyond_a_signed_int(spark):
    late = 2**32 - 5
    logs = logs_frame(spark, [("1", late, "t", "s", [("k", "v")])])
    assert get_logs(logs, "", late, late + 1).count() == 1
    assert sum(r["count"] for r in get_histograms(logs, "", late - 10, late + 4, None, 3).collect()) == 1
    assert logs.filter(F.col("date") == "2106-02-07").count() == 1


@pytest.mark.parametrize("reverse", [False, True])
def test_pages_by_rank_equal_pages(spark, monkeypatch, reverse):
    rng = random.Random(17)
    monkeypatch.setattr(search, "SLICES", 5)
    monkeypatch.setattr(search, "PASSED", 6)
    times = [rng.choice([3, 4, rng.randrange(0, 1000), 990]) for _ in range(160)]
    logs = logs_frame(spark, [(f"{n:03d}", BEGIN + t, "t", "s", [("k", str(n % 4))]) for n, t in enumerate(times)]).cache()
    wanted = key_compare("k", ">", 0)
    hits = sorted(((BEGIN + t, f"{n:03d}") for n, t in enumerate(times) if n % 4 and 2 <= t < 995), reverse=reverse)
    for lines, offset in [(10, 0), (7, 33), (1, len(hits) - 1), (30, len(hits) - 12), (500, 3), (5, len(hits)), (0, 2)]:
        page = get_logs_by_rank(logs, "", BEGIN + 2, BEGIN + 995, wanted, lines, offset, reverse).collect()
        assert [(r.time, r.log_id) for r in page] == hits[offset: offset + lines]
    assert get_logs_by_rank(logs, "", BEGIN + 9, BEGIN + 9, wanted).count() == 0


def test_a_deep_page_sorts_its_slice_only(spark, monkeypatch):
    monkeypatch.setattr(search, "PASSED", 50)
    logs = logs_frame(spark, [(f"{n:05d}", BEGIN + n, "t", "s", [("k", "1")]) for n in range(5000)])
    text = plan_of(get_logs_by_rank(logs, "", BEGIN, BEGIN + 5000, lines=10, offset=4900))
    # The page begins in a slice of five seconds; nothing before it is read or passed over.
    assert f">= {BEGIN + 4900})" in text
    assert "4910" not in text.replace(str(BEGIN + 4910), "")


def test_terms_are_combined_before_logs_are_read(spark):
    rng = random.Random(23)
    words = ["disk", "Full", "ok", "x"]
    logs = logs_frame(spark, [(f"{n:04d}", BEGIN + 40 * n, "t", "s", [("m", ",".join(rng.sample(words, rng.randrange(5))))])
                              for n in range(300)])
    groups = pack_log_groups(logs, 3, 3600, arrival=BEGIN).cache()
    postings = build_line_index(flatten_log_groups(groups), LINE)
    terms = {"disk": "Disk", "full": "full", "ok": "ok"}
    d, f, o = (F.col(n) for n in terms)
    for where in [d & f & ~o, d | (f & o), (d | f) & ~(d & f), o]:
        got = lookup_terms(postings, groups, terms, where, LINE, BEGIN + 100, BEGIN + 9000)
        plain = scan_logs(flatten_log_groups(groups), BEGIN + 100, BEGIN + 9000)
        expected = plain.withColumns({n: term_match(w, LINE) for n, w in terms.items()}).filter(where)
        assert tuples(got, "log_id", "time") == tuples(expected, "log_id", "time") != []
    assert got.columns == plain.columns
    for where, named in [(~d, terms), (d | ~o, terms), (F.lit(True), {})]:
        with pytest.raises(ValueError):
            lookup_terms(postings, groups, named, where, LINE)


def test_lookup_keys(spark, tmp_path):
    rng = random.Random(3)
    keys = {"n": IndexKey("long"), "x": IndexKey("double"), "msg": IndexKey("text", (" ",)), "raw": IndexKey("text")}
    rows = []
    for i in range(3_000):
        # a third of all logs have one number; some values are no numbers, some keys occur twice or not at all
        n = "7" if i % 3 == 0 else rng.choice(["-5", "12", "9223372036854775807", "x1", "", " 12 ", str(i)])
        contents = [("n", "12"), ("n", n), ("msg", rng.choice(["Disk full", "disk", "all ok", " ", ""])), ("raw", "A b")]
        if i % 4:
            contents.append(("x", rng.choice(["1.5", "-2", "1e3", "nan", ".5", "many"])))
        rows.append((f"{i:08d}", BEGIN + 60 * i, "t", f"s{i % 5}", contents))
    put_logs(pack_log_groups(logs_frame(spark, rows), 20, 3600), str(tmp_path / "store"), arrival=BEGIN)
    groups = read_groups(spark, str(tmp_path / "store"))
    write_key_index(build_key_postings(flatten_log_groups(groups), keys), str(tmp_path / "keys"))
    postings = read_key_index(spark, str(tmp_path / "keys"))
    tests = {"seven": KeyTest("n", "=", 7), "big": KeyTest("n", ">", 1000), "half": KeyTest("x", "<", 1.0),
             "disk": KeyTest("msg", "has", "DISK"), "raw": KeyTest("raw", "has", "a B"), "part": KeyTest("raw", "has", "b")}
    plain = scan_logs(flatten_log_groups(groups), BEGIN + 100, BEGIN + 90_000).withColumns({
        "seven": key_compare("n", "=", 7), "big": key_compare("n", ">", 1000), "half": key_compare("x", "<", 1.0, "double"),
        "disk": key_term_match("msg", "DISK", keys["msg"]), "raw": key_term_match("raw", "a B", keys["raw"]),
        "part": key_term_match("raw", "b", keys["raw"])})
    c = {n: F.col(n) for n in tests}
    for where in [c["seven"], c["big"] & ~c["disk"], (c["half"] | c["big"]) & c["disk"], c["raw"] & ~c["seven"]]:
        got = lookup_keys(postings, groups, keys, tests, where, BEGIN + 100, BEGIN + 90_000)
        assert tuples(got, "log_id", "time") == tuples(plain.filter(where), "log_id", "time") != []
    assert lookup_keys(postings, groups, keys, tests, c["part"]).count() == 0
    assert lookup_keys(postings.limit(0), groups.limit(0), keys, tests, c["raw"]).count() == 0


def test_lookup_keys_reads_files_by_their_bounds(spark, tmp_path):
    keys = {"n": IndexKey("long"), "m": IndexKey("long")}
    logs = logs_frame(spark, [(f"{i:08d}", BEGIN + i, "t", "s", [("n", str(i * 37 % 5000)), ("m", "1")]) for i in range(5000)])
    write_key_index(build_key_postings(logs, keys), str(tmp_path / "keys"))
    postings = read_key_index(spark, str(tmp_path / "keys"))
    near = postings.filter(KeyTest("n", ">", 4_990).of_postings(keys["n"]))
    assert near.count() == 9
    plan = plan_of(near)
    assert "GreaterThan(number,4990)" in plan and "PartitionFilters: [isnotnull(key" in plan
    files = postings.filter("key = 'n'").withColumn("f", F.input_file_name()).groupBy("f").agg(
        F.min("number").alias("a"), F.max("number").alias("b")).orderBy("a").collect()
    assert all(x["b"] < y["a"] for x, y in zip(files, files[1:], strict=False))


def test_refused_key_lookups(spark, logs):
    keys = {"n": IndexKey("long"), "w": IndexKey("text")}
    postings = build_key_postings(logs_frame(spark, []), keys)
    for test, where in [(KeyTest("other", "=", 1), F.col("a")), (KeyTest("n", "has", "x"), F.col("a")), (KeyTest("w", "<", 1), F.col("a")),
                        (KeyTest("n", "!", 1), F.col("a")), (KeyTest("n", "=", 1), ~F.col("a"))]:
        with pytest.raises(ValueError):
            lookup_keys(postings, postings, keys, {"a": test}, where)
    with pytest.raises(ValueError):
        build_key_postings(logs_frame(spark, []), {"": IndexKey("long")})
