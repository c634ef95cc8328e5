"""Small helpers around DataFrames that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.plans.scratch import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read back: a cut of the lineage that lost executors don't
    undo, and a size the planner knows when it chooses a join."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_text(text: str) -> Column:
    """The text as a string, NULL as the empty one."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def text_bytes(docs: DataFrame, text: str) -> int:
    """Bytes of all texts: one pass over one column, a single number."""
    return int(docs.agg(F.sum(F.octet_length(F.col(text).cast("string")).cast("bigint"))).first()[0] or 0)


def pieces(total: int, each: int) -> int:
    """How many pieces of size `each` hold `total`."""
    return max(1, -(-total // each))
