"""Cutting lineage in the folder that all executors share, and dealing rows to all cores."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def checkpointed(df: DataFrame) -> DataFrame:
    """df written once to the session's spark.checkpoint.dir. Only a local master, where driver and executors are one
    machine, may do without that setting."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        there = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not there and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(there or tempfile.mkdtemp(prefix="checkpoints-"))
    return df.checkpoint()


def spread(df: DataFrame) -> DataFrame:
    """df dealt evenly to all cores: for rows of few bytes and much work, which files of a few MB would leave to one task."""
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism)
