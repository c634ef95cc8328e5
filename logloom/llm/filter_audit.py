"""How filters interact: what each removes after any others, what it would have removed, what it costs.

1. Every filter becomes a relation of the rows that fail it, a table of ids bucketed by id. Rows have an id of
   their own, since a doc_id may be missing or repeated. Two more relations name the rows labelled good and toxic.
2. All ids are split by one relation after the other: a left-semi join keeps those in it, a left-anti join those
   that are not. The left-anti side along a prefix of filters is what the prefix lets through, the left-semi
   side what its last filter removes. A prefix's survivors depend on which filters it has, not on their order,
   so one pass over the relations splits the ids for all prefixes of all orders at once. The tables share
   buckets, so no join moves a row.
3. The parts of the split are counted per part of the corpus and failure pattern, at most `2^(filters + 2)` rows
   each. From these counts come, for every filter behind every set of others, the documents removed, the
   redundant ones (they fail, but went before), the label losses, and from those all orders.

A NULL text is the empty one and fails what the empty text fails; a NULL part is the empty string. Rows that
share a doc_id are documents of their own; labels of an id hold for all its rows, and an id labelled twice has
both labels. Of equal texts those with a larger doc_id than the least fail; a missing doc_id counts as larger than any,
and equal texts that all lack one pass. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from itertools import combinations, permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logloom.llm.tables import pieces, stored, whole_text
from logloom.plans.once import with_once
from logloom.plans.scratch import scratch_path

#: What a rule reads: the text, its words, the number of its words.
Rule = Callable[[Column, Column, Column], Column]

#: Ids in a bucket.
BUCKET_IDS = 1 << 22

RULES: dict[str, Rule] = {
    "A": lambda text, words, n: n < 200,
    "B": lambda text, words, n: 100 * F.size(F.array_distinct(words)) < 50 * n,
    "C": lambda text, words, n: 100 * F.length(F.regexp_replace(text, "[^A-Z]+", F.lit(""))) > 2 * F.length(text),
    "D": lambda text, words, n: text.rlike("[#$%&*|]"),
}
#: The filter that compares texts with each other.
DUPLICATE = "E"
_LABELS = {"good": "quality", "toxic": "toxic"}


def judge(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", part: str = "source",
          rules: dict[str, Rule] = RULES) -> DataFrame:
    """(row, doc_id, part, digest, a boolean per rule) of every document, stored. One pass over the texts."""
    whole = F.col("text")
    words = F.filter(F.split(whole, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        whole_text(text).alias("text"))
    rows = with_once(rows, "words", words)
    fails = [rule(whole, F.col("words"), F.size("words")).alias(name) for name, rule in rules.items()]
    found = rows.select("doc_id", "part", F.unhex(F.sha2(whole, 256)).alias("digest"), *fails)
    return stored(found.withColumn("row", F.monotonically_increasing_id()), "judged")


def repeats(judged: DataFrame) -> DataFrame:
    """Rows whose text is that of a smaller doc_id. Digests are added up before they move, and only those
    found twice meet the rows again, so that adaptive execution may split a frequent one."""
    many = judged.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    many = stored(many.drop("n"), "digests")
    later = F.col("least").isNotNull() & (F.col("doc_id").isNull() | (F.col("doc_id") > F.col("least")))
    return judged.join(many, "digest").filter(later).select("row")


def labelled(judged: DataFrame, labels: DataFrame, column: str, doc_id: str = "doc_id") -> DataFrame:
    """Rows whose doc_id has the label 1."""
    named = labels.filter(F.col(column) == 1).select(F.col(doc_id).cast("bigint").alias("doc_id"))
    named = stored(named.filter("doc_id is not null").distinct(), "labels")
    return judged.join(named, "doc_id", "left_semi").select("row")


class _Relations:
    """Tables of ids with common buckets, dropped together."""

    def __init__(self, spark, n_buckets: int):
        self.spark, self.n_buckets, self.names = spark, n_buckets, []

    def keep(self, rows: DataFrame, dealt: bool = True) -> DataFrame:
        """Store by bucket of the row id; `dealt` first, so that a bucket is one file."""
        name = f"ids_{uuid.uuid4().hex}"
        if dealt:
            rows = rows.repartition(self.n_buckets, "row")
        (rows.write.bucketBy(self.n_buckets, "row").sortBy("row").option("path", scratch_path(self.spark, "ids"))
         .saveAsTable(name))
        self.names.append(name)
        return self.spark.table(name)

    def drop(self) -> None:
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def split(rows: DataFrame, relations: dict[str, DataFrame], keep) -> DataFrame:
    """`rows` with `mask`, whose bit n tells whether the n-th relation holds the row."""
    rows = rows.withColumn("mask", F.lit(0))
    for n, ids in enumerate(relations.values()):
        inside = rows.join(ids, "row", "left_semi").withColumn("mask", F.col("mask") + F.lit(1 << n))
        rows = keep(inside.unionByName(rows.join(ids, "row", "left_anti")))
    return rows


def patterns(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", part: str = "source",
             rules: dict[str, Rule] = RULES) -> DataFrame:
    """(part, mask, n, n_good, n_toxic): documents by the set of filters they fail."""
    judged = judge(docs, text, doc_id, part, rules)
    spark = docs.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tables = _Relations(spark, max(least, pieces(judged.count(), BUCKET_IDS)))
    failing = {name: judged.filter(F.col(name)).select("row") for name in rules} | {DUPLICATE: repeats(judged)}
    failing |= {name: labelled(judged, labels, column) for name, column in _LABELS.items()}
    ids = {name: tables.keep(found) for name, found in failing.items()}
    found = split(tables.keep(judged.select("row", "part")), ids, lambda t: tables.keep(t, dealt=False))
    n_filters = len(rules) + 1
    label = lambda n: F.sum(F.getbit("mask", F.lit(n_filters + n)).cast("bigint"))
    counted = found.groupBy("part", F.col("mask").bitwiseAND(F.lit((1 << n_filters) - 1)).alias("mask")).agg(
        F.count(F.lit(1)).alias("n"), label(0).alias("n_good"), label(1).alias("n_toxic"))
    counted = stored(counted, "patterns")
    tables.drop()
    return counted


def _effects(names: list[str]) -> list[tuple]:
    """What a document of each failure pattern is to a filter behind a set of others: (mask, filter, before,
    kept, removed, redundant, unique, weight), the weight being the number of orders that put this set
    before the filter."""
    out = []
    bits = range(len(names))
    for f in bits:
        others = [b for b in bits if b != f]
        for k in range(len(others) + 1):
            weight = factorial(k) * factorial(len(others) - k)
            for before in (sum(1 << b for b in c) for c in combinations(others, k)):
                for mask in range(1 << len(names)):
                    fails, gone = bool(mask >> f & 1), bool(mask & before)
                    out.append((mask, names[f], before, int(not fails and not gone), int(fails and not gone),
                                int(fails and gone), int(mask == 1 << f), weight))
    return out


def _orders(names: list[str]) -> list[tuple]:
    """(filter_order, step, filter, before) of every order of the filters."""
    return [("".join(order), step + 1, order[step], sum(1 << names.index(x) for x in order[:step]))
            for order in permutations(names) for step in range(len(order))]


def audit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", part: str = "source",
          rules: dict[str, Rule] = RULES) -> DataFrame:
    """One row per part, order of the filters and step; the tables of all sets and orders are constants."""
    names = [*rules, DUPLICATE]
    counted = patterns(docs, labels, text, doc_id, part, rules)
    spark = docs.sparkSession
    effects = spark.createDataFrame(
        _effects(names), "mask int, filter string, before int, kept int, removed int, redundant int, unique int, weight bigint")
    orders = spark.createDataFrame(_orders(names), "filter_order string, step int, filter string, before int")
    total = lambda of, what: F.sum(F.col(of) * F.col(what))
    sums = counted.join(F.broadcast(effects), "mask").groupBy("part", "filter", "before", "weight").agg(
        total("n", "kept").alias("kept"), total("n", "removed").alias("removed"), total("n", "redundant").alias("redundant"),
        total("n", "unique").alias("unique_fails"), total("n_good", "removed").alias("good_lost"),
        total("n_toxic", "removed").alias("toxic_lost"))
    shapley = F.sum(F.col("removed") * F.col("weight")).over(W.partitionBy("part", "filter")).alias("shapley")
    return sums.select("*", shapley).join(F.broadcast(orders), ["filter", "before"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
