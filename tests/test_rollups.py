import random

import pytest

from logloom.operators.ingest import flatten_log_groups, pack_log_groups
from logloom.operators.rollups import merge_rollup, read_rollup, rollup_histograms, write_rollup
from logloom.operators.search import get_histograms

from helpers import logs_frame

BEGIN = 1_700_000_000


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """Groups of logs in two puts, and the counts of both; one was written twice."""
    rng = random.Random(4)
    path = str(tmp_path_factory.mktemp("rollup"))
    logs = logs_frame(spark, [(f"{n:04d}", BEGIN + rng.choice([rng.randrange(7000), 60 * rng.randrange(100), 3]), rng.choice("ab"), "s",
                               [("k", "1")]) for n in range(600)])
    groups = pack_log_groups(logs, 7, 900, arrival=BEGIN).cache()
    for name, part in [("1", "min_time % 2 = 0"), ("2", "min_time % 2 = 1"), ("2", "min_time % 2 = 1")]:
        write_rollup(groups.filter(part), path, name)
    return groups, path


@pytest.mark.parametrize("topic,first,last,bucket", [
    ("", 0, 7000, 3600), ("a", 40, 6040, 600), ("", 40, 6013, 120), ("b", 17, 5000, 90), ("", 10, 15, 3), ("", 41, 47, 60),
    ("a", 17, 7000, 7), ("", 40, 100, 60), ("", 100, 100, 60), ("", -5000, 9000, 777)])
def test_counts_and_edges_equal_all_logs(spark, kept, topic, first, last, bucket):
    groups, path = kept
    span = (BEGIN + first, BEGIN + last)
    rows = lambda h: sorted(map(tuple, h.select("from", "to", "count", "progress").collect()))
    expected = rows(get_histograms(flatten_log_groups(groups), topic, *span, bucket_seconds=bucket))
    for counts in (read_rollup(spark, path), merge_rollup(read_rollup(spark, path))):
        assert rows(rollup_histograms(counts, groups, topic, *span, bucket)) == expected


def test_whole_minutes_read_no_logs(spark, kept):
    groups, path = kept
    begin = BEGIN - BEGIN % 60
    histogram = rollup_histograms(read_rollup(spark, path), groups, "", begin, begin + 7200, 600)
    assert "logs" not in histogram._jdf.queryExecution().optimizedPlan().toString()
