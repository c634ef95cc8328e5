"""Index tables derived from logs: postings of tokens and typed key columns."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions.fields import compared, field, key_compare, key_term_match, line_tokens, term_match, tokens, typed
from logloom.functions.times import utc_day
from logloom.model import MAX_TIME, Index, IndexKey, IndexLine
from logloom.operators.ingest import expire_logs, flatten_log_groups
from logloom.operators.search import scan_logs

_ADDRESS = ["date", "shard", "log_id"]
#: Characters behind the cursor of its group in the id of a stored log.
_PLACE = 9
#: Columns of key postings before the address, and which of them holds the numbers of a type.
_VALUES = "key:string,token:string,number:bigint,real:double"
_NUMBERS = {"long": "number", "double": "real"}


def build_line_index(logs: DataFrame, line: IndexLine) -> DataFrame:
    """Postings (token, date, shard, log_id), one per distinct token of a log.

    Repeats are removed inside each row, so the index is built without a shuffle.
    """
    return logs.select(F.explode(line_tokens(line)).alias("token"), *_ADDRESS)


def build_key_index(logs: DataFrame, keys: Mapping[str, IndexKey]) -> DataFrame:
    """One column per key next to the address of its log: tokens, BIGINT or DOUBLE."""
    columns = []
    for name, key in keys.items():
        value = field(name)
        if key.type == "text":
            columns.append(tokens(value, key.token, key.case_sensitive).alias(name))
        else:
            columns.append(typed(value, key.type).alias(name))
    return logs.select("time", *_ADDRESS, *columns)


def build_index(logs: DataFrame, index: Index, as_of: int) -> tuple[DataFrame | None, DataFrame]:
    """Postings (None without a line index) and key columns of the logs inside the index's retention.
    A changed index is built anew."""
    kept = expire_logs(logs, index.ttl, as_of)
    postings = build_line_index(kept, index.line) if index.line else None
    return postings, build_key_index(kept, index.keys)


def token_bucket(token: Column, buckets: int) -> Column:
    """Bucket a token's postings are stored in."""
    return F.pmod(F.xxhash64(token), F.lit(buckets)).cast("int")


def lookup_term(postings: DataFrame, logs: DataFrame, term: str, line: IndexLine, from_time: int = 0,
                to_time: int = MAX_TIME + 1, buckets: int | None = None) -> DataFrame:
    """Logs of [from, to) that hold a term; the same logs that `term_match` finds.

    The postings, of these days only, tell which days and shards hold the term and from which to which
    log. That is a row per day and shard, however frequent the term, so it goes to all tasks; the scan of
    a store then opens only these folders, and the logs between the bounds are tested themselves. No log
    is shuffled. Stored postings need the number of buckets they were written with; the lookup then opens
    the files of one bucket per day.
    """
    wanted = F.lit(term if line.case_sensitive else term.lower())
    hits = postings.filter((F.col("token") == wanted) & F.col("date").between(utc_day(from_time), utc_day(to_time - 1)))
    if buckets is not None:
        hits = hits.filter(F.col("bucket") == token_bucket(wanted, buckets))
    places = hits.groupBy("date", "shard").agg(F.min("log_id").alias("_first"), F.max("log_id").alias("_last"))
    near = scan_logs(logs, from_time, to_time).join(F.broadcast(places), ["date", "shard"])
    near = near.filter(F.col("log_id").between(F.col("_first"), F.col("_last"))).drop("_first", "_last")
    return near.filter(term_match(term, line)).select(*logs.columns)


def lookup_terms(postings: DataFrame, groups: DataFrame, terms: Mapping[str, str], where: Column, line: IndexLine,
                 from_time: int = 0, to_time: int = MAX_TIME + 1, buckets: int | None = None) -> DataFrame:
    """Logs of [from, to) that satisfy an expression of several terms. `terms` names them, and `where` combines the names:
    `{"disk": "disk", "ok": "ok"}` and `F.col("disk") & ~F.col("ok")`. The same logs that `term_match` finds.

    The expression is settled by the postings of `flatten_log_groups(groups)`, log by log, before any log is read; then
    only the groups that hold a hit are flattened, and their logs tested. A term, however frequent, is spread over
    the logs it is in, and the hits go to all tasks only where their size allows. `where` must not hold for a
    log without any of the terms, which no posting tells of.
    """
    _refuse_where_of_nothing(postings, terms, where)
    tokens_ = {n: F.lit(t if line.case_sensitive else t.lower()) for n, t in terms.items()}
    near = postings.filter(F.col("token").isin(*tokens_.values()))
    if buckets is not None:
        near = near.filter(reduce(Column.__or__, [F.col("bucket") == token_bucket(t, buckets) for t in tokens_.values()]))
    found = {n: F.col("token") == t for n, t in tokens_.items()}
    return _logs_of_hits(near, groups, found, {n: term_match(t, line) for n, t in terms.items()}, where, from_time, to_time)


@dataclass(frozen=True)
class KeyTest:
    """What a log has to hold under one key: a number `op` the operand (`>`, `<=`, ...), or with the op `has` a token."""

    key: str
    op: str
    operand: str | int | float

    def of_postings(self, index_key: IndexKey) -> Column:
        """Whether a row of `build_key_postings` says so; NULL where it holds another type. A form that reaches the files."""
        if self.op == "has":
            if index_key.type != "text":
                raise ValueError(f"key {self.key!r} is indexed as {index_key.type}, not as text")
            wanted = str(self.operand)
            held = F.col("token") == F.lit(wanted if index_key.case_sensitive else wanted.lower())
        elif index_key.type not in _NUMBERS:
            raise ValueError(f"key {self.key!r} is indexed as {index_key.type}, not as a number")
        else:
            held = compared(F.col(_NUMBERS[index_key.type]), self.op, self.operand)
        return (F.col("key") == self.key) & held

    def of_logs(self, index_key: IndexKey) -> Column:
        """Whether a log does."""
        if self.op == "has":
            return key_term_match(self.key, str(self.operand), index_key)
        return key_compare(self.key, self.op, self.operand, index_key.type)


def build_key_postings(logs: DataFrame, keys: Mapping[str, IndexKey]) -> DataFrame:
    """Postings (key, token, number, real, date, shard, log_id) of typed values: a row per distinct token of a text key, one
    per number of a `long` (`number`) or `double` (`real`) one. Values of another type have none. No shuffle."""
    if "" in keys:
        raise ValueError("a key without a name cannot be stored")
    none = F.array().cast(f"array<struct<{_VALUES}>>")

    def of(name: str, key: IndexKey) -> Column:
        row = lambda **held: F.struct(*[
            held.get(c, F.lit(None)).cast(kind).alias(c) for c, kind in (v.split(":") for v in _VALUES.split(","))])
        value = field(name)
        if key.type == "text":
            held = F.array_distinct(tokens(value, key.token, key.case_sensitive))
            return F.coalesce(F.transform(held, lambda t: row(key=F.lit(name), token=t)), none)
        number = typed(value, key.type)
        return F.when(number.isNotNull(), F.array(row(key=F.lit(name), **{_NUMBERS[key.type]: number}))).otherwise(none)

    rows = F.concat(none, *[of(n, k) for n, k in keys.items()])
    return logs.select(F.explode(rows).alias("row"), *_ADDRESS).select("row.*", *_ADDRESS)


def lookup_keys(postings: DataFrame, groups: DataFrame, keys: Mapping[str, IndexKey], tests: Mapping[str, KeyTest],
                where: Column, from_time: int = 0, to_time: int = MAX_TIME + 1) -> DataFrame:
    """Logs of [from, to) that satisfy an expression of tests on keys, the same that `key_compare` and `key_term_match`
    find. `tests` names them, and `where` combines the names, as in `lookup_terms`.

    The expression is settled by the key postings of `flatten_log_groups(groups)`. Stored ones lie in folders per day and
    key, in files of adjacent values, so a test opens the files whose bounds it can meet; a NULL or missing key, or
    one of another type, meets none. `where` must not hold for a log that passes no test.
    """
    unknown = sorted({t.key for t in tests.values()} - set(keys))
    if unknown:
        raise ValueError(f"keys without an index: {unknown}")
    _refuse_where_of_nothing(postings, tests, where)
    found = {n: t.of_postings(keys[t.key]) for n, t in tests.items()}
    near = postings.filter(reduce(Column.__or__, found.values()))
    return _logs_of_hits(near, groups, found, {n: t.of_logs(keys[t.key]) for n, t in tests.items()}, where, from_time, to_time)


def _refuse_where_of_nothing(postings: DataFrame, named: Mapping, where: Column) -> None:
    if not named:
        raise ValueError("nothing to look up")
    if not postings.sparkSession.range(1).select(*[F.lit(False).alias(n) for n in named]).filter(where).isEmpty():
        raise ValueError("the expression holds for logs that no posting tells of")


def _logs_of_hits(near: DataFrame, groups: DataFrame, found: Mapping[str, Column], tested: Mapping[str, Column], where: Column,
                  from_time: int, to_time: int) -> DataFrame:
    """Settle an expression by postings, log by log, and test the logs of the groups that hold a hit."""
    days = F.col("date").between(utc_day(from_time), utc_day(to_time - 1))
    held = near.filter(days).groupBy(*_ADDRESS).agg(*[F.coalesce(F.bool_or(c), F.lit(False)).alias(n) for n, c in found.items()])
    cursor = F.expr(f"substring(log_id, 1, length(log_id) - {_PLACE})").alias("cursor")
    hit = held.filter(where).select("date", "shard", cursor).distinct()
    reach = days & (F.col("max_time") >= from_time) & (F.col("min_time") < to_time)
    logs = scan_logs(flatten_log_groups(groups.filter(reach).join(hit, ["date", "shard", "cursor"], "left_semi")), from_time, to_time)
    return logs.withColumns(dict(tested)).filter(where).select(*logs.columns)
