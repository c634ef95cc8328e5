"""Histograms while the logs still arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logloom.functions.times import floor_to
from logloom.model import COMPLETE
from logloom.streaming.runs import Trigger, start_batches

INCOMPLETE = "Incomplete"
_COUNTS = "from bigint, count bigint, last_time bigint"


def count_stream(logs: DataFrame, path: str, checkpoint: str, bucket_seconds: int, from_time: int = 0,
                 trigger: Trigger | None = None) -> StreamingQuery:
    """Count the logs of a stream with `time` per bucket, batch by batch, into a folder per batch.

    Buckets start at `from_time`, earlier logs are left out. The stream holds no state, so nothing grows
    in it, and a log counts however late it comes.
    """
    def write(batch: DataFrame, folder: str) -> None:
        start = floor_to(F.col("time"), bucket_seconds, from_time)
        counts = batch.filter(F.col("time") >= from_time).groupBy(start.alias("from")).agg(
            F.count(F.lit(1)).alias("count"), F.max("time").alias("last_time"))
        counts.write.mode("overwrite").parquet(f"{path}/{folder}")

    return start_batches(logs, write, checkpoint, trigger)


def live_histograms(spark: SparkSession, path: str, bucket_seconds: int, lateness: int) -> DataFrame:
    """Buckets counted so far: from, to, count and progress. A bucket is complete once the newest log is
    `lateness` seconds past its end; logs that come even later still count."""
    counted = spark.read.schema(_COUNTS).parquet(path).select("from", "count", "last_time")
    buckets = counted.groupBy("from").agg(F.sum("count").alias("count"), F.max("last_time").alias("last_time"))
    newest = counted.agg(F.max("last_time")).scalar()
    end = F.col("from") + bucket_seconds
    return buckets.select(
        "from", end.alias("to"), "count",
        F.when(end <= newest - lateness, COMPLETE).otherwise(INCOMPLETE).alias("progress"),
    )
