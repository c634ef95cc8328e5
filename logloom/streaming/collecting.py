"""Collecting from files as they appear."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from logloom.model import CollectConfig
from logloom.plans.collecting import Packing, check_destinations, collect_configs, write_collected
from logloom.sources.files import number_lines
from logloom.streaming.runs import Trigger, start_batches


def collect_stream(lines: DataFrame, configs: Sequence[CollectConfig], path: str, checkpoint: str, source: Column,
                   packing: Packing, routes: DataFrame | Callable[[DataFrame], DataFrame] | None = None, ingest_time: int | None = None,
                   trigger: Trigger | None = None) -> StreamingQuery:
    """Collect every micro-batch of `stream_log_files` into the stores below `path`, exactly once: a batch
    has a folder of its own in each store and replaces it when it is repeated.

    `routes` may be a function of a batch's lines, such as one that calls `routes_of`: then a batch looks up its own
    files only, and not all files there are."""
    check_destinations(configs)

    def write(batch: DataFrame, folder: str) -> None:
        lines = number_lines(batch)
        collected = collect_configs(lines, configs, source, routes(lines) if callable(routes) else routes, ingest_time)
        write_collected(collected, configs, path, packing, folder=folder)

    return start_batches(lines, write, checkpoint, trigger)
