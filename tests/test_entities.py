import random

from helpers import tuples
from logloom.operators.fleet import entity_snapshot
from logloom.streaming.entities import entities_of, entity_changes
from logloom.streaming.runs import start_files

SCHEMA = "name string, op string, time bigint, position bigint, n int, word string"
NAMES = ("name", "create_time", "modify_time", "n", "word")


def follow(spark, folder, steps):
    """Feed changes step by step; returns what each step has emitted."""
    seen, out = [], []
    for rows in steps:
        spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(f"{folder}/feed")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{folder}/feed")
        start_files(entity_changes(stream, ["n", "word"]), f"{folder}/out", f"{folder}/state").awaitTermination()
        emitted = tuples(spark.read.parquet(f"{folder}/out"), "name", "change", "position", "modify_time")
        out.append(sorted(set(emitted) - set(seen)))
        seen = emitted
    return spark.read.parquet(f"{folder}/out"), out


def test_only_changes_are_emitted(spark, tmp_path):
    emitted, steps = follow(spark, tmp_path, [
        [("a", "create", 10, 0, 1, "x"), ("b", "create", 11, 1, None, None), ("c", "create", 12, 2, 3, "z"), ("c", "delete", 13, 3, None, None)],
        [("b", "delete", 20, 5, None, None), ("d", "create", 20, 4, 2**31 - 1, 'q"\n')],
        [("b", "update", 30, 7, 5, "new"), ("b", "update", 31, 8, None, "é"), ("a", "update", 9, 0, 9, "again"), (None, "create", 1, 9, 1, "x")],
    ])
    assert steps == [
        [("a", "upsert", 0, 10), ("b", "upsert", 1, 11)], [("b", "delete", 5, 20), ("d", "upsert", 4, 20)],
        [("a", "late", 0, 9), ("b", "upsert", 8, 31)]]
    assert tuples(entities_of(emitted, ["n", "word"]), *NAMES) == [
        ("a", 10, 10, 1, "x"), ("b", 30, 31, None, "é"), ("d", 20, 20, 2**31 - 1, 'q"\n')]


def test_stream_equals_batch(spark, tmp_path):
    rng = random.Random(9)
    # a third of all changes have one name
    feed = [("hot" if rng.random() < 0.33 else f"n{rng.randrange(40)}", rng.choice(["create", "update", "update", "delete", None]),
             rng.randrange(1000), p, rng.choice([None, p]), rng.choice([None, "", f"w{p}"])) for p in range(600)]
    cuts = [0, *sorted(rng.sample(range(600), 3)), 600]
    steps = [rng.sample(feed[a:b], b - a) for a, b in zip(cuts, cuts[1:], strict=False)]
    emitted, _ = follow(spark, tmp_path, steps)
    expected = entity_snapshot(spark.createDataFrame(feed, SCHEMA), ["n", "word"])
    key = lambda rows: sorted(rows, key=repr)
    rows = lambda f: key(tuple(r) for r in f.select(*NAMES).collect())
    assert rows(entities_of(emitted, ["n", "word"])) == rows(expected)


def test_names_share_buckets_of_state(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("logloom.streaming.entities.BUCKETS", 4, raising=False)
    top = 2**62
    spark.createDataFrame([(f"n{i}", "create", i, top + i, i, None) for i in range(60)], SCHEMA).write.parquet(f"{tmp_path}/feed")
    for turn in range(2):
        query = start_files(entity_changes(spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/feed"), ["n", "word"]),
                            f"{tmp_path}/out", f"{tmp_path}/state")
        query.awaitTermination()
        assert turn or query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 4
        again = [(f"n{i}", "update", 100 + i, top + i + i % 2, 1000 + i, "w") for i in range(60)]
        spark.createDataFrame(again, SCHEMA).write.mode("append").parquet(f"{tmp_path}/feed")
    emitted = spark.read.parquet(f"{tmp_path}/out")
    assert emitted.filter("change = 'late'").count() == 30
    assert tuples(entities_of(emitted, ["n", "word"]), *NAMES) == sorted(
        (f"n{i}", i, 100 + i, 1000 + i, "w") if i % 2 else (f"n{i}", i, i, i, None) for i in range(60))
