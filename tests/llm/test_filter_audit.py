import re
from collections import Counter
from itertools import permutations

import brute

from logloom.llm import filter_audit


def plain(rows, labels):
    """rows: (doc_id, text, part); labels: (doc_id, quality, toxic)."""
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    fails, out = [], Counter()
    for i, t, _ in rows:
        t = t or ""
        words = brute.WORD.findall(t)
        first = least.get(t)
        fails.append({
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search(r"[#$%&*|]", t)),
            "E": first is not None and (i is None or i > first)})
    good, toxic = ({i for i, *v in labels if i is not None and v[k] == 1} for k in (0, 1))
    found, shapley = {}, Counter()
    for part in {p or "" for *_, p in rows}:
        mine = [n for n, r in enumerate(rows) if (r[2] or "") == part]
        for order in map("".join, permutations("ABCDE")):
            left = set(mine)
            for step, f in enumerate(order, 1):
                failing = {n for n in mine if fails[n][f]}
                gone = failing & left
                shapley[part, f] += len(gone)
                redundant = len(failing - left)
                left -= gone
                found[part, order, step] = (
                    len(left), len(gone), redundant, sum(sum(fails[n].values()) == 1 for n in failing),
                    sum(rows[n][0] in good for n in gone), sum(rows[n][0] in toxic for n in gone))
    return Counter((*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in found.items())


COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def audited(docs, labels):
    found = filter_audit.audit(docs, labels)
    assert found.columns == COLUMNS
    return Counter(map(tuple, found.collect()))


def test_documents(spark):
    docs, labels = brute.read("documents", "sf0.001"), brute.read("labels", "sf0.001")
    want = plain(list(zip(docs.doc_id, docs.text, docs.source)), list(zip(labels.doc_id, labels.quality, labels.toxic)))
    at = "/root/testdata/sf0.001/"
    assert audited(spark.read.parquet(f"{at}documents.parquet"), spark.read.parquet(f"{at}labels.parquet")) == want


def test_odd_rows(spark):
    long = "word " * 300
    rows = [*brute.ODD, (20, long), (21, long), (None, long), (22, "A" * 50 + "#"), (23, " ".join(f"w{n}" for n in range(300)))]
    labels = [(20, 1, 1), (21, None, 1), (21, 1, None), (22, 1, 0), (22, 1, 0), (None, 1, 1), (999, 1, 1)]
    docs = brute.frame(spark, rows)
    labelled = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    assert audited(docs, labelled) == plain([(i, t, None if i is None else f"s{i % 2}") for i, t in rows], labels)


def test_empty_tables(spark):
    docs = brute.frame(spark, brute.ODD)
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert audited(docs.limit(0), labels) == Counter()
    assert sum(r[7] + r[8] for r in audited(docs, labels)) == 0


def test_a_hot_text_and_part(spark):
    rows = [(n, "the same text" if n % 2 else f"text {n}", "hot" if n % 3 else f"s{n}") for n in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(7)
    labels = spark.createDataFrame([(n, n % 2, 1) for n in range(0, 300, 7)], "doc_id bigint, quality int, toxic int")
    got = audited(docs, labels)
    assert {r: n for r, n in got.items() if r[0] == "hot"} == {
        r: n for r, n in plain(rows, [(n, n % 2, 1) for n in range(0, 300, 7)]).items() if r[0] == "hot"}


def test_tables_are_dropped_and_joins_move_nothing(spark, capsys):
    before = len(spark.catalog.listTables())
    filter_audit.audit(brute.frame(spark, brute.ODD), spark.createDataFrame([(1, 1, 1)], "doc_id bigint, quality int, toxic int"))
    assert len(spark.catalog.listTables()) == before
    tables = filter_audit._Relations(spark, 8)
    ids = tables.keep(spark.range(50).select(filter_audit.F.col("id").alias("row")))
    plans = []

    def keep(t):
        t.explain()
        plans.append(capsys.readouterr().out)
        return tables.keep(t, dealt=False)

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = filter_audit.split(ids, {"x": tables.keep(ids.filter("row % 2 = 0")), "y": tables.keep(ids.filter("row < 10"))}, keep)
        assert Counter(r["mask"] for r in found.collect()) == {0: 20, 1: 20, 2: 5, 3: 5}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        tables.drop()
    assert plans and not any("Exchange" in p for p in plans)
