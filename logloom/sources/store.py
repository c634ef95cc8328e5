"""The log store: Parquet below one path, partitioned by day and shard."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.functions.cursors import make_cursor, of_put, part_of, put_of
from logloom.functions.times import floor_to, utc_date
from logloom.model import GROUPS_SCHEMA, KEY_POSTINGS_SCHEMA, POSTINGS_SCHEMA
from logloom.operators.index import token_bucket
from logloom.operators.ingest import check_groups, describe_groups, first_second, split_days
from logloom.plans.scratch import scratch_path
from logloom.sources.puts import Put, Puts

_DAY = 86_400


def _folder(spark: SparkSession, path: str):
    """Hadoop path and file system of a folder."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return root, root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _children(spark: SparkSession, path: str) -> list[str]:
    root, fs = _folder(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []


def written_by_stream(spark: SparkSession, path: str) -> bool:
    """Whether streams write this path, in folders per run and batch. Folders per day beside them would
    be another layout, which no reader takes together."""
    return any(c.startswith("run=") for c in _children(spark, path))


def written_by_batch(spark: SparkSession, path: str) -> bool:
    """Whether a batch job has written this path."""
    return any(c.startswith("date=") for c in _children(spark, path))


def _write(groups: DataFrame, path: str, mode: str) -> None:
    # Ranges gather a day's shard, however small, into one file, and what lies close in time of a large one (a hot
    # shard), which they cut; sorted cursors then make row groups skippable. They are cut by a sample, for which the
    # groups are made a second time; so their keys are values that are the same then, which a cursor need not be. The
    # hash lets a single second be cut, too.
    (
        groups.repartitionByRange("date", "shard", "min_time", F.xxhash64("topic", "source", "logs"))
        .sortWithinPartitions("date", "shard", "cursor")
        .write.mode(mode).partitionBy("date", "shard").parquet(path)
    )


def put_logs(groups: DataFrame, path: str, rejects_path: str | None = None, mode: str = "append",
             arrival: int | None = None, put: Put | None = None) -> None:
    """Store groups. Empty ones write nothing; groups across midnight are cut there.

    A put takes the next number of the store's order (`sources.puts`) before it writes, or comes with one it has
    taken earlier, and all its cursors start with its arrival and number: `arrival`, a UNIX time, or now, but no
    earlier than the put before it. `read_settled` shows whole puts in their order, so that a follower misses
    nothing and sees nothing twice. Groups that bring cursors keep them where no arrival is given; such a put, of a
    store that is moved, has the order its cursors have and takes no number.

    Groups with a log without time, a time out of range, or a content without key or value go to
    `rejects_path` with the reason, or fail the whole write where no such path is given. With rejects
    the groups are judged once, into the scratch folder, from which first the rejects and then the valid
    ones are written; the store itself is written last.
    """
    spark = groups.sparkSession
    if written_by_stream(spark, path):
        raise ValueError(f"{path} is written by streams; store the groups below another path")
    if "cursor" in groups.columns and arrival is None and put is None:
        _put(groups, path, rejects_path, mode, None)
        return
    order = Puts(spark, path)
    put = put or order.claim(arrival)
    try:
        _put(groups, path, rejects_path, mode, put)
    except BaseException:
        order.abandon(put.number)
        raise
    order.end(put)


def _put(groups: DataFrame, path: str, rejects_path: str | None, mode: str, put: Put | None) -> None:
    if rejects_path is None:
        _write(valid_groups(groups, put), path, mode)
        return
    checked = check_groups(groups).withColumn("valid", F.col("reject_reason").isNull())
    judged = scratch_path(groups.sparkSession, "judged")
    checked.write.partitionBy("valid").parquet(judged)
    checked = groups.sparkSession.read.schema(checked.schema).parquet(judged)
    checked.filter("not valid").drop("valid").write.mode(mode).parquet(rejects_path)
    _write(_stored_form(checked.filter("valid").drop("valid"), put), path, mode)


def put_batch(groups: DataFrame, path: str, rejects_path: str | None = None) -> None:
    """Write one batch of a stream to a folder of its own; a repeated batch replaces what was there. Batches of one
    stream follow each other; their groups arrive when they run."""
    _put(groups, path, rejects_path, "overwrite", None)


def valid_groups(groups: DataFrame, put: Put | None = None) -> DataFrame:
    """Groups in stored form; the first invalid one fails the job."""
    failure = F.raise_error(F.concat(F.lit("invalid log group: "), F.col("reject_reason")))
    valid = F.when(F.col("reject_reason").isNotNull(), failure.cast("boolean")).otherwise(True)
    return _stored_form(check_groups(groups).filter(valid), put)


def _stored_form(groups: DataFrame, put: Put | None = None) -> DataFrame:
    groups = groups.drop("reject_reason")
    extra = [c for c in groups.columns if c not in GROUPS_SCHEMA.names]
    cursor_of = (lambda key: of_put(put.arrival, put.number, key)) if put else (
        lambda key: make_cursor(F.unix_timestamp(), key))
    if "cursor" not in groups.columns:
        return describe_groups(split_days(groups), cursor_of(F.expr("uuid()")), extra)
    given = cursor_of(F.col("cursor")) if put else F.col("cursor")
    whole = groups.withColumn("given_cursor", given).drop("cursor").withColumn("first_day", utc_date(first_second()))
    # The part of the first day keeps the cursor, one cut off gets its own.
    day = utc_date(first_second())
    cursor = F.when(day == F.col("first_day"), F.col("given_cursor")).otherwise(
        part_of(F.col("given_cursor"), day.cast("string")))
    return describe_groups(split_days(whole), cursor, extra)


def read_settled(spark: SparkSession, path: str, extra: T.StructType | None = None) -> DataFrame:
    """Groups of all puts before the first that is still being written. What a follower reads: `end` of these groups
    bounds what is there, and later puts lie behind it, also those of the same second."""
    settled = Puts(spark, path).settled()  # first, so that whatever it names is listed below
    groups = read_groups(spark, path, extra)
    if settled.bound is None:
        return groups
    groups = groups.filter(F.col("cursor") < settled.bound)
    return groups.filter(~put_of(F.col("cursor")).isin([f"{n:08x}" for n in settled.void])) if settled.void else groups


def read_groups(spark: SparkSession, path: str, extra: T.StructType | None = None) -> DataFrame:
    """Groups of a store. Columns beyond the stored schema are kept by `put_logs`; name those to read
    in `extra`, they are NULL in files that lack them."""
    schema = T.StructType([*GROUPS_SCHEMA.fields, *(extra.fields if extra else ())])
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def write_line_index(postings: DataFrame, path: str, buckets: int, mode: str = "append") -> None:
    """Store postings in folders per day and bucket of tokens, sorted by token.

    A lookup opens one bucket of the days it asks for and skips the row groups of other tokens; new days
    are appended, expired ones dropped with `drop_expired`. Rebalancing cuts a bucket that a frequent token
    has made large into several files.
    """
    (
        postings.withColumn("bucket", token_bucket(F.col("token"), buckets))
        .hint("rebalance", "date", "bucket")
        .sortWithinPartitions("date", "bucket", "token", "log_id")
        .write.mode(mode).partitionBy("date", "bucket").parquet(path)
    )


def read_line_index(spark: SparkSession, path: str) -> DataFrame:
    """Stored postings."""
    return spark.read.schema(POSTINGS_SCHEMA).parquet(path)


def write_key_index(postings: DataFrame, path: str, mode: str = "append") -> None:
    """Store key postings in folders per day and key, clustered by range of values.

    A file holds adjacent values, so its bounds tell a lookup whether to open it. Ranges go on with the
    log behind the value: a value that many logs have fills several files. The ranges are cut by a sample,
    for which the input is read a second time.
    """
    order = ["date", "key", "token", "number", "real", "log_id"]
    (
        postings.repartitionByRange(*order).sortWithinPartitions(*order)
        .write.mode(mode).partitionBy("date", "key").parquet(path)
    )


def read_key_index(spark: SparkSession, path: str) -> DataFrame:
    """Stored key postings."""
    return spark.read.schema(KEY_POSTINGS_SCHEMA).parquet(path)


def drop_expired(spark: SparkSession, path: str, ttl: int, as_of: int) -> list[str]:
    """Delete the days of a store whose last second has passed the retention; returns them.

    Works on directories only, one per day (and batch of a stream); no log is read.
    """
    root, fs = _folder(spark, path)
    first_kept = dt.datetime.fromtimestamp(as_of - ttl * _DAY, dt.timezone.utc).date().isoformat()
    dropped = set()
    for pattern in ("date=*", "run=*/batch=*/date=*"):
        found, _ = _folder(spark, f"{path.rstrip('/')}/{pattern}")
        for status in fs.globStatus(found) or []:
            day = status.getPath().getName()[5:]
            if day < first_kept:
                fs.delete(status.getPath(), True)
                dropped.add(day)
    return sorted(dropped)
