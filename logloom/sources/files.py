"""Raw log files as lines, in batch and as a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LINE = "value string"


def plain_path(uri: Column) -> Column:
    """Path of a file URI, without scheme and host and with its escapes resolved."""
    path = F.regexp_replace(uri, r"\A[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    return F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)


def _located(lines: DataFrame) -> DataFrame:
    return lines.select(
        plain_path(F.col("_metadata.file_path")).alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.col("value").alias("line"),
    )


def number_lines(lines: DataFrame) -> DataFrame:
    """Add `line_id`: increasing and without gaps inside a (file_path, block_start).

    Only right directly on a scan; a shuffle or a filter before it breaks the numbering.
    """
    return lines.select("*", F.monotonically_increasing_id().alias("line_id"))


def read_log_files(spark: SparkSession, path: str, pattern: str = "*", line_sep: str = "\n") -> DataFrame:
    """Lines (file_path, block_start, line, line_id) of all files below `path` whose name matches
    the glob. (file_path, block_start, line_id) is the order of the lines; large files are read in
    parallel blocks."""
    return number_lines(_located(
        spark.read.schema(_LINE).option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true").option("lineSep", line_sep).text(path)
    ))


def stream_log_files(spark: SparkSession, path: str, pattern: str = "*", line_sep: str = "\n",
                     max_files: int | None = None) -> DataFrame:
    """The same as a stream of new files, unnumbered: number the lines inside `foreachBatch`.
    A file has to be complete when it appears."""
    reader = (
        spark.readStream.schema(_LINE).option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true").option("lineSep", line_sep)
    )
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _located(reader.text(path))
