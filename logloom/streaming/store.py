"""Writing to and following a log store as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logloom.functions.times import utc_day
from logloom.model import GROUPS_SCHEMA
from logloom.operators.ingest import flatten_log_groups
from logloom.sources.store import put_batch, written_by_batch
from logloom.streaming.runs import Trigger, start_batches


def put_logs_stream(groups: DataFrame, path: str, checkpoint: str, rejects_path: str | None = None,
                    trigger: Trigger | None = None) -> StreamingQuery:
    """Stream form of `put_logs`: stores groups exactly once, a folder per batch, clustered like a batch
    write. Groups without a cursor arrive when their batch runs. Invalid ones go to `rejects_path`, or
    fail the stream where there is none. The path belongs to streams alone."""
    if written_by_batch(groups.sparkSession, path):
        raise ValueError(f"{path} is written by batch jobs; store the stream below another path")

    def write(batch: DataFrame, folder: str) -> None:
        put_batch(batch, f"{path}/{folder}", rejects_path and f"{rejects_path}/{folder}")

    return start_batches(groups, write, checkpoint, trigger)


def tail_logs(spark: SparkSession, path: str, max_files: int | None = None,
              start_time: int | None = None) -> DataFrame:
    """Stream of the logs of a store, from a start time if given; at most `max_files` files per step.
    The checkpoint of whatever consumes it is the position to resume from."""
    reader = spark.readStream.schema(GROUPS_SCHEMA)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    groups = reader.parquet(path)
    if start_time is None:
        return flatten_log_groups(groups)
    # whole groups first, by the columns that the scan can skip files and row groups by
    late = groups.filter((F.col("date") >= utc_day(start_time)) & (F.col("max_time") >= start_time))
    return flatten_log_groups(late).filter(F.col("time") >= start_time)
