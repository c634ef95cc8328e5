"""Where intermediate tables of a job go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"


def _base(spark: SparkSession) -> str | None:
    return (
        spark.conf.get(_SETTING, None)
        or spark.sparkContext.getConf().get(_SETTING)
        or spark.sparkContext.getCheckpointDir()
    )


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder the cluster names in `spark.checkpoint.dir`, or that the job has
    set as its checkpoint folder."""
    base = _base(spark)
    if not base:
        raise ValueError(f"set {_SETTING} to a folder that all executors share")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def use_local_scratch(spark: SparkSession) -> None:
    """Give a session on one machine a checkpoint folder of its own where it has none, as in tests."""
    if not _base(spark) and spark.sparkContext.master.startswith(("local[", "local")) \
            and not spark.sparkContext.master.startswith("local-cluster"):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
