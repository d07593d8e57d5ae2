"""Cutting lineage at a place that survives the loss of executors."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder.

    Without one, a folder of this machine serves a local master (tests, notebooks); on a cluster executors would not see
    it, so a missing setting is an error there.
    """
    context = spark.sparkContext
    known = context.getCheckpointDir()
    if known:
        return known
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not named and not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(named or tempfile.mkdtemp(prefix="gotera-checkpoint-"))
    return context.getCheckpointDir()


def settle(df: DataFrame) -> DataFrame:
    """Compute once and keep the result in the checkpoint folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch(spark: SparkSession) -> str:
    """A new folder all executors can see, beside the session's checkpoints."""
    return f"{checkpoint_dir(spark)}/scratch-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Compute once and keep the rows as Parquet beside the checkpoints: for tables that are read several times, a few
    columns each time."""
    path = f"{scratch(df.sparkSession)}/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
