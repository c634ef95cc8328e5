"""Files to records to logs to groups in a store, then read back in every way there is."""

import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from helpers import tuples
from logloom.functions.cursors import cursor_at
from logloom.functions.fields import field, key_compare, key_term_match, term_match
from logloom.model import IndexKey, IndexLine, ShardRange
from logloom.operators.consume import list_shards, next_cursors, pull_logs, resolve_cursor
from logloom.operators.index import build_line_index, lookup_term
from logloom.operators.ingest import assign_shard, flatten_log_groups, pack_log_groups
from logloom.operators.search import find_logs, get_histograms, get_logs, histogram_total, scan_groups
from logloom.plans.collecting import accepted, collect_logs, rejected
from logloom.sources.files import read_log_files
from logloom.sources.store import put_logs, read_groups
from workload import tables as t

SF = "/root/testdata/sf0.001"
LINE = IndexLine((",", ":", " "), include_keys=("message",))


@pytest.fixture(scope="module")
def documents(spark):
    return [r for r in t.table(spark, SF, "documents").collect() if r.lang in ("en", "fr", "de") and r.source != "src3"]


@pytest.fixture(scope="module")
def groups(spark, tmp_path_factory):
    config = replace(t.TEXTS, log_path=t.write_document_files(spark, SF))
    lines = read_log_files(spark, config.log_path, config.file_pattern)
    collected = collect_logs(lines, config, F.lit("host-1"))
    assert rejected(collected).select("reject_reason").distinct().first()[0] == "time does not parse"
    path = str(tmp_path_factory.mktemp("stores"))
    # a group arrives with the newest of its logs
    logs = assign_shard(accepted(collected), 3, key="log_id")
    put_logs(pack_log_groups(logs, 4, 1800, F.col("max_time")), path + "/groups")
    return read_groups(spark, path + "/groups")


def time_of(document):
    return t.JAN_1 + 60 * document.doc_id


def words(document):
    return {w.lower() for w in re.split("[,: ]", document.text) if w}


def test_everything_collected_is_stored_once(groups, documents):
    logs = flatten_log_groups(groups)
    got = tuples(logs, "time", "topic", "source", field("doc"), field("message"))
    assert got == sorted((time_of(d), d.lang, "host-1", str(d.doc_id), d.text) for d in documents)


def test_searches_agree(groups, documents):
    start, end = t.JAN_1 + 600, t.JAN_1 + 9000
    inside = [d for d in documents if start <= time_of(d) < end]
    stored = scan_groups(groups, start, end)
    for term in ("the", "La", "und", "absent"):
        wanted = sorted((str(d.doc_id),) for d in inside if term.lower() in words(d))
        assert tuples(find_logs(stored, start, end, "", term_match(term, LINE)), field("doc")) == wanted
        assert tuples(lookup_term(build_line_index(stored, LINE), stored, term, LINE), field("doc")) == wanted
        total = histogram_total(get_histograms(stored, "", start, end, term_match(term, LINE), 700)).first()["count"]
        assert total == len(wanted)
    english = key_term_match("message", "the", IndexKey("text", (",", ":", " "))) & ~key_compare("doc", "<=", 50)
    page = get_logs(stored, "en", start, end, english, lines=5, reverse=True).collect()
    expected = sorted((d.doc_id for d in inside if d.lang == "en" and "the" in words(d) and d.doc_id > 50), reverse=True)
    assert [int(r.fields["doc"]) for r in page] == expected[:5]


def test_shards_are_read_from_a_time_to_the_head(groups, documents):
    start = t.JAN_1 + 3600
    first = {r.shard: r.cursor for r in resolve_cursor(groups, [start]).collect()}
    assert set(first) == {r.shard for r in list_shards(groups).collect()} == {0, 1, 2}
    ranges, seen = [ShardRange(s, c) for s, c in first.items()], []
    while ranges:
        pulled = pull_logs(groups, ranges, 7).cache()
        seen += [r.doc for r in flatten_log_groups(pulled).select(field("doc").alias("doc")).collect()]
        ranges = [ShardRange(r.shard, r.next_cursor) for r in next_cursors(pulled, ranges).collect() if r.n_groups]
    whole = groups.filter(F.col("cursor") >= cursor_at(start))
    assert sorted(seen) == sorted(r.doc for r in flatten_log_groups(whole).select(field("doc").alias("doc")).collect())
    assert set(seen) >= {str(d.doc_id) for d in documents if time_of(d) >= start + 1800}
