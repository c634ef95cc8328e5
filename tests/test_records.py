import random

import pytest

from helpers import tuples
from logloom.operators.collect import assemble_records
from logloom.sources.files import read_log_files
from logloom.sources.growing import follow_log_files
from logloom.streaming.records import open_records, read_records, records_stream


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "logs").mkdir()
    return tmp_path / "logs"


def append(path, text):
    with open(path, "ab") as file:
        file.write(text.encode())


def step(spark, tmp_path, now=0, idle_s=None, split=1 << 20):
    lines = follow_log_files(spark, str(tmp_path / "logs"), "*.log*", split_bytes=split)
    records_stream(lines, "[A-Z].*", str(tmp_path / "out"), str(tmp_path / "state"), idle_s, clock=lambda: now).awaitTermination()
    names = ("file_path", "record", "part", "n_lines", "body")
    short = lambda rows: [(r[0].rpartition("/")[2], *r[1:]) for r in rows]
    out = str(tmp_path / "out")
    return short(tuples(read_records(spark, out), *names)), short(tuples(open_records(spark, out), *names))


def test_a_cut_record_is_whole(spark, tmp_path, folder):
    log = folder / "a.log"
    append(log, "lead\nA one\n one b\n")
    assert step(spark, tmp_path) == ([("a.log", 0, 0, 1, "lead")], [("a.log", 1, 0, 2, "A one\n one b")])
    append(log, " one c\nB two\n")
    append(folder / "b.log", "only lead\n")
    ended, held = step(spark, tmp_path)
    assert ended[1:] == [("a.log", 1, 0, 3, "A one\n one b\n one c")]
    assert held == [("a.log", 2, 0, 1, "B two"), ("b.log", 0, 0, 1, "only lead")]
    append(folder / "b.log", " more\n")
    ended, held = step(spark, tmp_path)
    assert held == [("a.log", 2, 0, 1, "B two"), ("b.log", 0, 0, 2, "only lead\n more")]
    append(log, "C\n")
    assert step(spark, tmp_path)[0][2:] == [("a.log", 2, 0, 1, "B two")]


def test_records_outlive_rotation(spark, tmp_path, folder):
    log = folder / "a.log"
    append(log, "A one\n")
    step(spark, tmp_path)
    append(log, " rest\nB two\n")
    log.rename(folder / "a.log.1")
    append(log, "C three\n and on\n")
    ended, held = step(spark, tmp_path)
    assert ended == [("a.log.1", 1, 0, 2, "A one\n rest")]
    assert held == [("a.log", 1, 0, 2, "C three\n and on"), ("a.log.1", 2, 0, 1, "B two")]
    # Renamed without new lines: the name begins anew, so the record has ended.
    (folder / "a.log.1").rename(folder / "a.log.2")
    log.rename(folder / "a.log.1")
    append(log, "D four\n")
    ended, held = step(spark, tmp_path)
    assert ended == [("a.log", 1, 0, 2, "C three\n and on"), ("a.log.1", 1, 0, 2, "A one\n rest")]
    assert ("a.log", 1, 0, 1, "D four") in held


def test_a_record_ends_by_time(spark, tmp_path, folder):
    append(folder / "a.log", "A one\n")
    append(folder / "b.log", "B\n")
    step(spark, tmp_path, now=100, idle_s=50)
    append(folder / "b.log", " b\n")
    assert step(spark, tmp_path, now=140, idle_s=50)[0] == []
    append(folder / "b.log", " c\n")
    ended, held = step(spark, tmp_path, now=150, idle_s=50)
    assert (ended, held) == ([("a.log", 1, 0, 1, "A one")], [("b.log", 1, 0, 3, "B\n b\n c")])
    append(folder / "a.log", " late\nZ\n")
    ended, held = step(spark, tmp_path, now=160, idle_s=50)
    assert ended == [("a.log", 1, 0, 1, "A one"), ("a.log", 1, 1, 1, " late")]
    assert held[0] == ("a.log", 2, 0, 1, "Z")


def test_any_steps_give_what_a_batch_gives(spark, tmp_path, folder):
    rng = random.Random(9)
    for turn in range(4):
        for name in "abc":
            if rng.random() < 0.8:
                append(folder / f"{name}.log", "".join(
                    rng.choice(["A", "", "  ", "é"]) + "x" * rng.randrange(30) + "\n" for _ in range(rng.randrange(1, 25))))
        ended, held = step(spark, tmp_path, split=97)
    whole = assemble_records(read_log_files(spark, str(folder), "*.log"), "[A-Z].*")
    expected = [(r[0].rpartition("/")[2], *r[1:]) for r in tuples(whole, "file_path", "record", "part", "n_lines", "body")]
    assert sorted(ended + held) == expected
