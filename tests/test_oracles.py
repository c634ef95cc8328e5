"""Every registered query against DuckDB on the same tables."""

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry
from workload.oracles import ORACLES
from workload.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in sorted(Path(SF).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def rows(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in records), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    frame = QUERIES[name](spark, SF)
    result = duck.execute(ORACLES[name])
    expected_names = [d[0] for d in result.description]
    assert sorted(frame.columns) == sorted(expected_names)
    got = rows(frame.columns, [tuple(r) for r in frame.collect()])
    want = rows(expected_names, result.fetchall())
    assert len(got) == len(want)
    assert len(got) > 0
    assert got == want


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry(spark).count() == 24
