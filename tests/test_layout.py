"""How many files the writers leave, and what lies together in them."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from helpers import groups_frame, logs_frame
from logloom.operators.ingest import pack_log_groups
from logloom.sources.store import put_logs, read_groups

PARTITIONS = 16
DAY = 86_400
BEGIN = 19_700 * DAY


@pytest.fixture
def uncoalesced(spark):
    """As many tasks as a large put has, on few rows."""
    settings = {"spark.sql.shuffle.partitions": str(PARTITIONS), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def hourly(spark, days):
    """Groups of one log, ten an hour."""
    logs = logs_frame(spark, [(f"{d:03d}{n:04d}", BEGIN + d * DAY + n * 360, "t", f"s{n % 3}", [("k", "v")])
                              for d in range(days) for n in range(240)])
    return pack_log_groups(logs, 1, 3600)


def test_small_days_are_a_file_each_however_many_tasks_write(spark, tmp_path, uncoalesced):
    days = 12
    put_logs(hourly(spark, days), str(tmp_path / "s"), arrival=BEGIN)
    files = list((tmp_path / "s").rglob("*.parquet"))
    folders = {f.parent for f in files}
    assert len(folders) >= days
    assert len(files) <= len(folders) + PARTITIONS
    assert read_groups(spark, str(tmp_path / "s")).agg(F.sum("n_logs")).first()[0] == days * 240


def test_a_large_day_is_cut_by_time(spark, tmp_path, uncoalesced):
    put_logs(hourly(spark, 1), str(tmp_path / "s"), arrival=BEGIN)
    groups = read_groups(spark, str(tmp_path / "s")).withColumn("file", F.input_file_name())
    for shard in {Path(f).parent.name for f in (tmp_path / "s").rglob("*.parquet")}:
        bounds = groups.filter(F.col("shard") == int(shard[6:])).groupBy("file").agg(
            F.min("min_time").alias("a"), F.max("min_time").alias("b")).orderBy("a").collect()
        assert len(bounds) > 2
        assert all(x["b"] <= y["a"] for x, y in zip(bounds, bounds[1:], strict=False))


def test_a_large_second_is_cut(spark, tmp_path, uncoalesced):
    rows = [("t", "s", None, [(BEGIN, [("k", f"{n:04d}")])]) for n in range(400)]
    put_logs(groups_frame(spark, rows), str(tmp_path / "s"))
    assert len(list((tmp_path / "s").rglob("*.parquet"))) > 3
    assert read_groups(spark, str(tmp_path / "s")).select("cursor").distinct().count() == 400
