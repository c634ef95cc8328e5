from collections import Counter

import brute
import pytest
from pyspark.sql import functions as F

from logloom.llm import host_rules
from logloom.llm.host_rules import Limits, host_quality


def test_measures_and_base_of_all_documents(spark):
    got = {r["doc_id"]: r for r in host_quality(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()}
    docs = brute.read("documents")
    for i, text in zip(docs.doc_id, docs.text):
        want = brute.measures(text)
        assert tuple(got[i][c] for c in host_rules.MEASURES) == want
        assert got[i]["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0])
    assert sum(r["kept"] for r in got.values()) > 0.9 * len(got)


def test_odd_rows(spark):
    got = host_quality(brute.frame(spark, brute.ODD))
    assert got.columns.count("n_words") == 1 and {"row", "chunk", "text"} <= set(got.columns)
    measured = Counter((r["doc_id"], *(r[c] for c in host_rules.MEASURES)) for r in got.collect())
    assert measured == Counter((i, *brute.measures(t)) for i, t in brute.ODD)
    assert all(not r["kept"] for r in got.filter("text is null").collect())


def test_empty_table(spark):
    assert host_quality(brute.frame(spark, brute.ODD).limit(0)).count() == 0


@pytest.mark.parametrize("n_clean, fails", [(1, True), (30, False)])
def test_failing_hosts_keep_their_clean_documents(spark, n_clean, fails):
    clean = [(f"clean {n} " + " ".join(f"w{n}x{k}" for k in range(20)), "bad") for n in range(n_clean)]
    symbols = [(" ".join(f"###w{n}x{k}%%%" for k in range(20)), "bad") for n in range(20)]
    others = [(f"good {n} " + " ".join(f"v{n}x{k}" for k in range(20)), f"h{n % 5}") for n in range(50)]
    odd = [(" ".join(f"###u{k}%%%" for k in range(20)), "h0")]
    docs = spark.createDataFrame([*clean, *symbols, *others, *odd], "text string, source string")
    got = host_quality(docs, limits=Limits())
    assert got.filter("host_failed").select("source").distinct().collect() == ([("bad",)] if fails else [])
    kept = got.filter("kept")
    assert kept.filter(F.col("text").startswith("clean")).count() == n_clean
    assert kept.filter(F.col("text").startswith("###") & (F.col("source") == "bad")).count() == (0 if fails else 20)
    assert kept.filter(F.col("text").startswith("###u")).count() == 1  # a good host's document may be odd


def test_small_hosts_are_shrunk_towards_the_others(spark):
    rows = [("bad", True)] + [(f"h{n % 10}", n % 50 == 0) for n in range(2000)]
    measured = spark.createDataFrame(rows, "source string, f boolean").withColumn(
        "failures", F.struct(*[F.col("f").alias(r) for r in host_rules.RULES]))
    got = {r["host"]: r for r in host_rules.host_verdicts(measured).collect()}
    assert got["bad"]["rate_short"] < 1 and got["h0"]["rate_short"] == pytest.approx(got["h0"]["n_short"] / 200, abs=0.02)


def test_no_python_in_the_plan(spark, capsys):
    measured = host_rules.measure(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    measured.explain("formatted")
    plan = capsys.readouterr().out
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Exchange"))
