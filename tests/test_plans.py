"""Plans that have to hold whatever the size of the data."""

import re
from pathlib import Path

import pytest

import logloom
from workload.queries import QUERIES
from logloom.operators.collect import assemble_records
from workload import tables

SF = "/root/testdata/sf0.001"
# these write a table or run a stream before they return
WRITERS = {"put_logs", "scan_groups", "put_logs_stream", "tail_logs", "live_histograms", "lookup_term", "read_log_files",
           "collect_logs", "collect_logs_stream", "pull_logs", "next_cursors", "follow_shards", "expire_logs", "scan_logs",
           "get_logs", "get_logs_by_rank", "get_histograms", "histogram_total", "follow_log_files", "follow_records",
           "rollup_histograms", "lookup_terms"}


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITERS))
def test_no_nested_loops_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|Python|InPandas|InArrow", text)


@pytest.mark.parametrize("name", ["flatten_contents", "assign_shard", "scan_logs", "term_match", "key_term_match",
                                  "key_compare", "build_line_index", "build_key_index", "extract_fields",
                                  "filter_records", "parse_log_time", "derive_topic", "expire_logs"])
def test_row_wise_operators_do_not_shuffle(spark, name):
    assert "Exchange" not in plan(QUERIES[name](spark, SF))


def test_packing_shuffles_the_contents_once(spark):
    groups = tables.event_groups(spark, SF)
    groups.collect()
    final = plan(groups).split("== Initial Plan ==")[0]
    # where no window is hot, the branch for hot ones is found empty and dropped
    assert len([l for l in final.splitlines() if "Exchange hashpartitioning" in l and "contents" in l]) <= 1


def test_records_share_one_shuffle_of_the_lines(spark):
    records = assemble_records(tables.document_lines(spark, SF), "[A-Z].*")
    records.collect()
    final = plan(records).split("== Initial Plan ==")[0]
    assert re.search(r"ReusedExchange \[file_path#\d+, block_start#\d+L, line_id#\d+, line#\d+\]", final)


@pytest.mark.parametrize("name", ["expire_logs", "scan_logs", "get_logs", "get_histograms", "histogram_total"])
def test_a_range_of_time_prunes_the_store(spark, name):
    text = plan(QUERIES[name](spark, SF))
    filters = text.split("PartitionFilters: [")[1].split("]")[0]
    assert "date#" in filters and ">=" in filters


def test_lookups_prune_days_and_shards_and_shuffle_no_logs(spark):
    text = plan(QUERIES["lookup_term"](spark, SF))
    assert "dynamicpruning" in text and "bucket#" in text
    assert not [l for l in text.splitlines() if "Exchange hashpartitioning" in l and "contents" in l]


@pytest.mark.parametrize("name, table, scans", [("route_records", "events", 1), ("entity_snapshot", "orders", 2),
                                                ("expand_machine_groups", "supplier", 2)])
def test_inputs_are_read_once(spark, name, table, scans):
    """Plus once for the deletions of a snapshot, and for the groups, which are made of suppliers, too."""
    assert plan(QUERIES[name](spark, SF)).count(f"/{table}.parquet") == scans


def test_a_page_keeps_its_top_rows_only(spark):
    assert "TakeOrderedAndProject(limit=200, offset=100" in plan(QUERIES["get_logs"](spark, SF))


#: What is broadcast by hint, or comes to the driver: a few heavy keys, a row per day and shard, the places
#: of a pull of few groups, a cursor per range of a pull.
BOUNDED = {"heavy_keys(keyed, _GROUP_KEY, heat", "places", "near", "slices"}  # slices: checked against MAX_OPEN
#: Rows that come to the driver: one per range of a pull, per slice of a page's search (`SLICES`), per shard of a list the
#: caller holds.
COLLECTED = {"consume.py": 1, "search.py": 1, "shards.py": 2}


def test_only_what_is_bounded_is_broadcast_by_hint():
    for file in Path(logloom.__file__).parent.rglob("*.py"):
        if "llm" in file.parts:
            continue
        text = file.read_text()
        assert not re.search(r"localCheckpoint|toPandas|crossJoin|udf", text), file
        assert text.count(".collect()") == COLLECTED.get(file.name, 0), file
        assert set(re.findall(r"F\.broadcast\(([^)]*)", text)) <= BOUNDED, file
