import inspect

import pytest

from helpers import tuples
from logloom.sources import growing
from logloom.sources.growing import Folder, follow_log_files
from logloom.streaming.runs import start_files
from workload import tables


@pytest.fixture
def log(tmp_path):
    (tmp_path / "logs" / "a").mkdir(parents=True)
    return tmp_path / "logs" / "a" / "app.log"


def append(path, text):
    with open(path, "ab") as file:
        file.write(text if isinstance(text, bytes) else text.encode())


def step(spark, tmp_path, **options):
    """Read what is new; returns all lines read so far."""
    lines = follow_log_files(spark, str(tmp_path / "logs"), "*.log*", **options)
    start_files(lines, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    return sorted(r[0] for r in tuples(spark.read.parquet(str(tmp_path / "out")), "line"))


def test_lines_are_read_once_while_files_grow_and_rotate(spark, tmp_path, log):
    append(log, "1 one\n2 two\n3 ha")
    assert step(spark, tmp_path) == ["1 one", "2 two"]
    append(log, "lf\n4 four\n")
    append(log.parent / "other.log", "no end")
    append(log.parent / "left.txt", "x\n")
    assert step(spark, tmp_path) == ["1 one", "2 two", "3 half", "4 four"]
    # Rotation: the rest of the old file, and all of the new one.
    append(log, "5 five\n")
    log.rename(log.with_name("app.log.1"))
    append(log, "6 six\n7")
    assert step(spark, tmp_path)[4:] == ["5 five", "6 six"]
    append(log, " seven\n")
    log.rename(log.with_name("app.log.2"))
    assert step(spark, tmp_path)[6:] == ["7 seven"]
    assert step(spark, tmp_path)[7:] == []
    # Emptied and written anew.
    log.with_name("app.log.2").write_text("8 eight\n")
    assert step(spark, tmp_path)[7:] == ["8 eight"]
    found = spark.read.parquet(str(tmp_path / "out")).filter("line like '7%'").first()
    assert (found.position, found.file_path.rpartition("/")[2]) == (6, "app.log.2")


def test_splits_cut_between_lines(spark, tmp_path, log):
    lines = [f"{n:04d} " + "é" * (n % 37) for n in range(300)] + ["", "9999 " + "x" * 5000, "9999z"]
    append(log, "\n".join(lines) + "\n")
    assert step(spark, tmp_path, split_bytes=101) == sorted(lines)
    rows = tuples(spark.read.parquet(str(tmp_path / "out")), "position", "line")
    data = log.read_bytes()
    assert all(data[p: p + len(x.encode())] == x.encode() and (p == 0 or data[p - 1] == 10) for p, x in rows)


def test_bytes_that_are_no_text_and_no_files(spark, tmp_path, log):
    assert Folder(str(tmp_path / "nothing"), "*").snapshot() == {}
    append(log, b"a\xff\n")
    assert step(spark, tmp_path) == ["a�"]


def test_a_repeated_step_reads_the_same_bytes_after_rotation(tmp_path, log):
    reader = growing._Reader(str(tmp_path / "logs"), "*.log*", 1 << 20)
    append(log, "one\ntwo\n")
    first = reader.latestOffset()
    append(log, "three\n")
    second = reader.latestOffset()
    read = lambda: [r for s in reader.partitions(first, second) for b in reader.read(s) for r in b["line"].to_pylist()]
    assert read() == ["three"]
    log.rename(log.with_name("app.log.1"))
    append(log, "four\n")
    assert read() == ["three"]
    assert reader.partitions(second, second) == []
    log.with_name("app.log.1").unlink()
    with pytest.raises(FileNotFoundError):
        read()


def test_a_split_is_handed_on_in_small_batches(tmp_path, log):
    append(log, "".join(f"{n}\n" for n in range(40_000)))
    reader = growing.GrowingFiles({"path": str(tmp_path / "logs")}).streamReader(None)
    parts = reader.partitions(reader.initialOffset(), reader.latestOffset())
    batches = [b for p in parts for b in reader.read(p)]
    assert max(b.num_rows for b in batches) < 20_000
    assert [line for b in batches for line in b["line"].to_pylist()] == [str(n) for n in range(40_000)]


def test_files_are_written_batch_by_batch(spark, tmp_path):
    spark.range(900).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' AS ts", "concat('t', id % 3) AS event_type", "id / 2 AS value",
    ).write.parquet(f"{tmp_path}/events.parquet")
    names = {"spark.sql.execution.arrow.maxRecordsPerBatch": "7", "spark.sql.shuffle.partitions": "2"}
    before = {n: spark.conf.get(n) for n in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        for n in range(2):
            tables.append_events(spark, str(tmp_path), str(tmp_path / "logs"), n, 2, rotate=n == 1)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    for kind in range(3):
        for n, file in enumerate((f"t{kind}.log.1", f"t{kind}.log")):
            mine = [i for i in range(900) if i % 3 == kind and i % 2 == n]
            assert (tmp_path / "logs" / file).read_text() == "".join(f"2024-01-01 00:00:00|{i}|t{kind}|{i / 2}|end\n" for i in mine)
    assert ".groupBy(" not in inspect.getsource(tables.append_events)
