"""Starting streams whose batches may be repeated."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

Trigger = dict[str, str | bool]
#: Read what is there, then stop. A service gives `{"processingTime": "1 minute"}` or the like.
ONCE: Trigger = {"availableNow": True}


def start_files(stream: DataFrame, path: str, checkpoint: str, trigger: Trigger | None = None) -> StreamingQuery:
    """Append to Parquet files, exactly once."""
    return (
        stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or ONCE)).start()
    )


def start_batches(stream: DataFrame, each: Callable[[DataFrame, str], None], checkpoint: str,
                  trigger: Trigger | None = None) -> StreamingQuery:
    """Hand every micro-batch to `each`, with a folder name of its own.

    The name holds the stream's identity, which its checkpoint keeps, and the number of the batch. A
    batch that is repeated gets the same name, so writing there with overwriting neither loses nor doubles
    rows, and another checkpoint never writes to the same folder.
    """
    def run(batch: DataFrame, number: int) -> None:
        identity = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        each(batch, f"run={identity}/batch={number}")

    return (
        stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or ONCE)).start()
    )
