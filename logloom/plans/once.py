"""Columns that are computed once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """`withColumn` for an expensive expression that later filters use.

    Spark moves a filter below a projection by repeating the projected expressions in it, a regex
    once per mention. It cannot move one below a generator, so the value is generated as the only
    element of an array.
    """
    others = [c for c in df.columns if c != name]
    return df.select(*others, F.explode(F.array(value)).alias(name))
