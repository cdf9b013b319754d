"""Cutting the lineage of rounds."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` from the session's checkpoint folder (``spark.checkpoint.dir``), which all machines share. Only a session
    of one local process, as in tests, gets a scratch folder where it is unset."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        found = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not found and (not context.master.startswith("local") or context.master.startswith("local-cluster")):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        context.setCheckpointDir(found or tempfile.mkdtemp(prefix="docketry-"))
    return df.checkpoint()


def small(df: DataFrame, most: int = 100_000) -> DataFrame:
    """``df``, stored, for the side of a join that is expected to be small: sent to all tasks if it has ``most`` rows at
    most, and joined by its keys beyond that."""
    df = checkpointed(df)
    return F.broadcast(df) if df.count() <= most else df
