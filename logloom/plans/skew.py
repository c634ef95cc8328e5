"""Keeping hot keys off single tasks.

A key is heavy when it holds more than `min_rows` rows and more than a 1/`max_keys` share of all
rows. Fewer than `max_keys` keys can exceed that share, so the list of heavy keys is bounded however
large the data, and may be broadcast; every other key is small enough for one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Heat:
    """When a key counts as heavy."""

    max_keys: int = 100_000
    min_rows: int = 1_000_000


DEFAULT_HEAT = Heat()


def _heavy_name(key: str) -> str:
    return f"heavy_{key}"


def heavy_keys(df: DataFrame, keys: Sequence[str], heat: Heat = DEFAULT_HEAT) -> DataFrame:
    """Fewer than `heat.max_keys` rows, one per heavy key: its columns prefixed with `heavy_` and its
    number of rows `heavy_rows`."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("heavy_rows"))
    total = counts.agg(F.sum("heavy_rows")).scalar()
    rows = F.col("heavy_rows")
    return counts.filter((rows > heat.min_rows) & (rows * heat.max_keys > total)).select(
        *[F.col(k).alias(_heavy_name(k)) for k in keys], "heavy_rows"
    )


def is_heavy(keys: Sequence[str]) -> Column:
    """Join condition between rows and `heavy_keys`; NULL keys match NULL."""
    return reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(_heavy_name(k))) for k in keys])
