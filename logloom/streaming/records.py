"""Multi-line records of files that still grow: a record that a step cuts is held open until the next one.

Each batch assembles its own lines as `assemble_records` does, in blocks and whatever the size of a file. Across
batches goes one row per file: the open record, its number, and the byte at which the file goes on. That table is
written anew into a folder per batch from the one before, so a repeated batch finds what it found at first and
replaces what it wrote: no record is lost, doubled or cut.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logloom.operators.collect import assemble_records
from logloom.sources.files import number_lines
from logloom.streaming.runs import Trigger, start_batches

_OPEN = "file_path string, record bigint, part bigint, n_lines bigint, body string, goes_on bigint, seen bigint"
_RECORDS = "file_path string, record bigint, part bigint, n_lines bigint, body string"
#: Where a scan numbers its rows, the number of its partition starts at this bit.
_PARTITION_BIT = 33


def _folder(path: str, kind: str, folder: str) -> str:
    return f"{path}/{kind}/{folder}"


def _previous(spark: SparkSession, path: str, folder: str) -> DataFrame:
    """What the batch before has left open."""
    run, _, number = folder.rpartition("=")
    if int(number) == 0:
        return spark.createDataFrame([], _OPEN)
    return spark.read.schema(_OPEN).parquet(_folder(path, "open", f"{run}={int(number) - 1}"))


def _matched(held: DataFrame, files: DataFrame) -> DataFrame:
    """Open records with the file of this batch that goes on where they ended (`now`): of the same name, else, where that
    name begins anew or has no lines, another of its folder; NULL where there is none. `anew` tells that another
    file has taken the name."""
    known = files.select(F.col("file_path").alias("now"), F.col("first").alias("at"))
    named = held.join(known, F.col("file_path") == F.col("now"), "left")
    same = named.withColumn("on", F.coalesce(F.col("at") == F.col("goes_on"), F.lit(False)))
    stays = same.filter("on").select(*held.columns, "now", F.lit(False).alias("anew"))
    above = lambda name: F.expr(f"substring({name}, 1, length({name}) - length(substring_index({name}, '/', -1)))")
    free = known.join(stays.select("now"), "now", "left_anti").filter("at > 0").groupBy(
        above("now").alias("_above"), F.col("at").alias("goes_on")).agg(F.min("now").alias("moved"))
    others = same.filter("not on").withColumns({"_above": above("file_path"), "anew": F.col("now").isNotNull()}).drop("now", "at", "on")
    # Of several records that could go on in one file, the last one seen does.
    taker = others.groupBy("_above", "goes_on").agg(F.max_by("file_path", F.struct("seen", "file_path")).alias("file_path"))
    moved = taker.join(free, ["_above", "goes_on"]).select("file_path", "moved")
    others = others.join(moved, "file_path", "left").select(*held.columns, F.col("moved").alias("now"), "anew")
    return stays.unionByName(others)


def _step(lines: DataFrame, held: DataFrame, begin_regex: str, now: int, idle_s: int | None) -> tuple[DataFrame, DataFrame]:
    """Records that end in a batch, and what stays open after it."""
    numbered = number_lines(lines).withColumn("block_start", F.shiftright("line_id", _PARTITION_BIT))
    files = numbered.groupBy("file_path").agg(F.min("position").alias("first"), F.max("next_position").alias("goes_on"))
    found = assemble_records(numbered, begin_regex)
    matched = _matched(held, files)
    on = matched.filter("now is not null")
    base = on.select(F.col("now").alias("file_path"), F.col("record").alias("base"), F.col("part").alias("base_part"))
    # Of an open record and the lines that follow it, each is one row.
    carried = on.filter("body is not null").select(
        F.col("now").alias("file_path"), "record", "part", F.lit(0).alias("place"), "n_lines", "body")
    own = found.join(base, "file_path", "left").select(
        "file_path", (F.coalesce("base", F.lit(0)) + F.col("record")).alias("record"),
        F.when(F.col("record") == 0, F.coalesce("base_part", F.lit(0))).otherwise(0).cast("bigint").alias("part"),
        F.lit(1).alias("place"), "n_lines", "body")
    pieces = F.array_sort(F.collect_list(F.struct("place", "body")))
    records = carried.unionByName(own).groupBy("file_path", "record", "part").agg(
        F.sum("n_lines").alias("n_lines"), F.array_join(F.transform(pieces, lambda p: p["body"]), "\n").alias("body"))
    last = own.groupBy("file_path").agg(F.max("record").alias("last")).join(files.select("file_path", "goes_on"), "file_path")
    records = records.join(last, "file_path")
    stale = F.lit(False) if idle_s is None else F.col("body").isNotNull() & (F.lit(now) - F.col("seen") >= idle_s)
    rest = matched.filter("now is null").withColumn("stale", stale)
    columns = [c.split()[0] for c in _RECORDS.split(", ")]
    ended = records.filter("record < last").select(*columns).unionByName(
        rest.filter("body is not null and (anew or stale)").select(*columns))
    waits = rest.filter("not anew").select(
        "file_path", "record", F.when(F.col("stale"), F.col("part") + 1).otherwise(F.col("part")).alias("part"),
        F.when(F.col("stale"), 0).otherwise(F.col("n_lines")).cast("bigint").alias("n_lines"),
        F.when(~F.col("stale"), F.col("body")).alias("body"), "goes_on", "seen")
    open_ = records.filter("record = last").select(*columns, "goes_on", F.lit(now).cast("bigint").alias("seen"))
    return ended, open_.unionByName(waits)


def records_stream(lines: DataFrame, begin_regex: str, path: str, checkpoint: str, idle_s: int | None = None,
                   trigger: Trigger | None = None, clock=time.time) -> StreamingQuery:
    """Records (file_path, record, part, n_lines, body) of `follow_log_files` below `path`, each as soon as the next one
    of its file has begun, another file has taken its name, or nothing was added to it for `idle_s` seconds
    (never, by default; looked at when a batch comes). Lines that still follow a record ended by time are its next part.

    A rotated file is known by the byte it goes on at. Two of one folder that go on at the same byte, both renamed
    between two steps, can't be told apart, and one renamed in one step that grows in a later one has its open record
    ended by then; the lines that follow are record 0 of the new name.
    """
    def write(batch: DataFrame, folder: str) -> None:
        spark = batch.sparkSession
        ended, open_ = _step(batch, _previous(spark, path, folder), begin_regex, int(clock()), idle_s)
        ended.write.mode("overwrite").parquet(_folder(path, "ended", folder))
        open_.write.mode("overwrite").parquet(_folder(path, "open", folder))

    return start_batches(lines, write, checkpoint, trigger)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Records that have ended."""
    return spark.read.schema(_RECORDS).parquet(f"{path}/ended").select("file_path", "record", "part", "n_lines", "body")


def open_records(spark: SparkSession, path: str) -> DataFrame:
    """Records that are still open after the last batch of each stream."""
    held = spark.read.schema(f"{_OPEN}, run string, batch bigint").parquet(f"{path}/open")
    last = held.groupBy("run").agg(F.max("batch").alias("batch"))
    return held.join(last, ["run", "batch"]).filter("body is not null").select("file_path", "record", "part", "n_lines", "body")
