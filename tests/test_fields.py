import random
import re

import pytest
from pyspark.sql import functions as F

from helpers import logs_frame
from logloom.functions.fields import (
    field, field_map, has_token, key_compare, key_term_match, line_tokens, term_match, tokens,
)
from logloom.model import IndexKey, IndexLine

COMMON = (",", ":", " ")


def values(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "v string")


def test_last_value_of_a_repeated_key_wins(spark):
    logs = logs_frame(spark, [("1", 0, "t", "s", [("a", "1"), ("b", "2"), ("a", "3")])])
    row = logs.select(field("a").alias("a"), field("c").alias("c"), field_map().alias("m")).first()
    assert (row.a, row.c, row.m) == ("3", None, {"a": "3", "b": "2"})


@pytest.mark.parametrize("delimiters, expected", [
    (COMMON, ["error", "code", "500", "x\ny"]),
    ((), ["error: code,500 x\ny"]),
    (("code", "5"), ["error: ", ",", "00 x\ny"]),
    (("e", "er"), ["ror: cod", ",500 x\ny"]),
    (("]", "^", "-", "\\", "&"), ["error: code,500 x\ny"]),
])
def test_tokens(spark, delimiters, expected):
    row = values(spark, "ERROR: Code,500 x\ny").select(tokens(F.col("v"), delimiters).alias("t")).first()
    if delimiters in (("code", "5"), ("e", "er")):  # case matters for delimiters, folding comes after
        row = values(spark, "error: code,500 x\ny").select(tokens(F.col("v"), delimiters).alias("t")).first()
    assert row.t == expected


@pytest.mark.parametrize("term, case_sensitive, expected", [
    ("internalservererror", False, True),
    ("InternalServerError", True, True),
    ("internalservererror", True, False),
    ("Server", False, False),
    ("a.b", False, True),
    ("axb", False, False),
    ("last", False, True),
    ("last\n", False, False),
    ("", False, False),
    ("code:500", False, False),
])
def test_term_is_a_whole_token(spark, term, case_sensitive, expected):
    frame = values(spark, "InternalServerError:a.b,code:500 last")
    assert frame.select(has_token(F.col("v"), term, COMMON, case_sensitive).alias("h")).first().h is expected


def test_delimiters_that_overlap_split_from_the_left(spark):
    row = values(spark, "abc").select(
        has_token(F.col("v"), "a", ("ab", "bc")).alias("a"), has_token(F.col("v"), "c", ("ab", "bc")).alias("c")
    ).first()
    assert (row.a, row.c) == (False, True)


def test_a_missing_value_does_not_match(spark):
    row = values(spark, None).select(has_token(F.col("v"), "x", COMMON).alias("a"), has_token(F.col("v"), "x", ()).alias("b")).first()
    assert (row.a, row.b) == (False, False)


def test_line_index_selects_keys_and_ignores_key_names(spark):
    logs = logs_frame(spark, [("1", 0, "t", "s", [("error", "one two"), ("note", "three one")])])
    find = lambda term, **kw: logs.filter(term_match(term, IndexLine(COMMON, **kw))).count()
    assert find("three") == 1
    assert find("error") == 0
    assert find("three", exclude_keys=("note",)) == 0
    assert find("three", include_keys=("note",)) == 1
    assert find("two", include_keys=("note",)) == 0
    assert find("three", include_keys=("note",), exclude_keys=("note",)) == 0
    assert sorted(logs.select(line_tokens(IndexLine(COMMON)).alias("t")).first().t) == ["one", "three", "two"]


def test_key_term(spark):
    logs = logs_frame(spark, [("1", 0, "t", "s", [("a", "x y"), ("b", "z")])])
    assert logs.filter(key_term_match("a", "Y", IndexKey("text", COMMON))).count() == 1
    assert logs.filter(key_term_match("b", "Y", IndexKey("text", COMMON))).count() == 0
    with pytest.raises(ValueError):
        key_term_match("a", "y", IndexKey("long"))
    with pytest.raises(ValueError):
        IndexKey("float")


@pytest.mark.parametrize("value, key_type, matches", [
    ("5", "long", True), (" 5 ", "long", True), ("5.5", "long", False), ("abc", "long", False),
    ("99999999999999999999", "long", False), ("5.5", "double", True), ("1e3", "double", True),
    ("5d", "double", False), ("NaN", "double", False), ("4", "long", False), (None, "long", False),
])
def test_numbers_compare_by_value(spark, value, key_type, matches):
    logs = logs_frame(spark, [("1", 0, "t", "s", [("n", value)])])
    row = logs.select(key_compare("n", ">", 4, key_type).alias("m")).first()
    assert row.m is matches


def test_unknown_comparison(spark):
    with pytest.raises(ValueError):
        key_compare("n", "!=", 4)


@pytest.mark.parametrize("delimiters", [(",",), COMMON, ("|", "\\", "$", "^"), ("ab", "a"), ("--", "-"), ("\n", "é"), ("X",)])
@pytest.mark.parametrize("case_sensitive", [False, True])
def test_tokens_and_terms_are_those_of_a_plain_split(spark, delimiters, case_sensitive):
    rng = random.Random(len(delimiters))
    alphabet = "aAbxX,: |\\$^-\n\u00e9."
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(12))) for _ in range(300)]
    splitter = "|".join(re.escape(d) for d in sorted(delimiters, key=len, reverse=True))
    fold = (lambda t: t) if case_sensitive else str.lower
    expected = [[fold(t) for t in re.split(splitter, text) if t] for text in texts]
    terms = ["a", "A", "x", "bx", ".", "X", "a.", "\n"]
    frame = values(spark, *texts).select(
        tokens(F.col("v"), delimiters, case_sensitive).alias("t"),
        *[has_token(F.col("v"), term, delimiters, case_sensitive).alias(f"h{n}") for n, term in enumerate(terms)])
    for row, want in zip(frame.collect(), expected):
        assert row.t == want
        assert [row[f"h{n}"] for n in range(len(terms))] == [fold(term) in want for term in terms]
