import pytest
from pyspark.sql import functions as F

from logloom.model import Shard, ShardRange
from logloom.operators import shards as sh


@pytest.fixture(scope="module")
def logs(spark):
    """A third of all logs have one source; some have none."""
    source = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 11 == 0, None).otherwise(F.concat(F.lit("s"), F.col("id") % 700))
    return spark.range(30_000).select(F.format_string("%08d", "id").alias("log_id"), source.alias("source"), F.lit(9).alias("shard"))


def shares(logs, held):
    got = sh.assign_shard_by_range(logs, held)
    assert sorted(got.columns) == sorted(logs.columns)
    counts = {r["shard"]: r["count"] for r in got.groupBy("shard").count().collect()}
    assert sum(counts.values()) == 30_000
    return {s: n / 30_000 for s, n in counts.items()}


def test_even_shards_cover_all_positions(logs):
    for n in (1, 3, 64):
        held = sh.even_shards(n)
        assert len(sh.open_shards(held)) == n and set(shares(logs, held)) <= set(range(n))
    one = sh.assign_shard_by_range(logs.filter("source <> 'hot'"), sh.even_shards(8))
    assert one.groupBy("source").agg(F.countDistinct("shard").alias("n")).filter("n > 1").isEmpty()


@pytest.mark.parametrize("n, most", [(1, 0.1), (4, 0.05), (16, 0.2)])
def test_a_hot_shard_splits(logs, n, most):
    before = sh.even_shards(n)
    held = sh.split_shards(logs, before, most, 77)
    old, new = shares(logs, before), shares(logs, held)
    assert max(new.values()) <= most * 1.02
    hot = {s for s, share in old.items() if share > most}
    assert {s.shard for s in held if s.closed_at == 77} == hot == {s.parent for s in held if s.parent is not None}
    assert not hot & set(new) and all(new[s] == old[s] for s in set(old) - hot)
    assert sum(s.parent in hot for s in held) <= sum(-(-old[s] // most) for s in hot)
    # What has been split, can be split again; a second look finds nothing to do.
    assert sh.split_shards(logs, held, most * 1.02, 78) == held
    again = sh.split_shards(logs, held, most / 2, 79)
    assert max(shares(logs, again).values()) <= most / 2 * 1.02


def test_equal_positions_stay_together(spark, logs):
    same = logs.limit(1).crossJoin(spark.range(100)).drop("id")
    held = sh.even_shards(2)
    split = sh.split_shards(same, held, 0.1, 5)
    assert len({r["shard"] for r in sh.assign_shard_by_range(same, split).select("shard").collect()}) == 1
    assert sh.split_shards(logs.limit(0), held, 0.1, 5) == held


def test_ranges_of_a_reader(spark):
    held = [Shard(0, 0, 8, None, 5), Shard(1, 8, sh.SPACE), Shard(2, 0, 3, 0), Shard(3, 3, 8, 0)]
    assert sh.follow_ranges(held, {0: "a", 1: "b"}) == [ShardRange(0, "a"), ShardRange(1, "b"), ShardRange(2, ""), ShardRange(3, "")]
    assert sh.shards_of(sh.shards_frame(spark, held)) == held


@pytest.mark.parametrize("held", [
    [], [Shard(0, 0, 5)], [Shard(0, 0, 5), Shard(1, 6, sh.SPACE)], [Shard(0, 0, 7), Shard(1, 6, sh.SPACE)],
    [Shard(0, 0, 5), Shard(0, 5, sh.SPACE)], [Shard(0, 0, sh.SPACE, None, 3)],
])
def test_ranges_have_to_cover(held):
    with pytest.raises(ValueError):
        sh.open_shards(held)


def test_refused(logs):
    for share in (0, 1.5):
        with pytest.raises(ValueError):
            sh.split_shards(logs, sh.even_shards(1), share, 0)
    with pytest.raises(ValueError):
        sh.even_shards(0)
