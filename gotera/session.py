"""Session settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # narrow sorted rows take up to forty times their compressed size; 64 MB joined into one task would be 2 GB and more
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # methods above this size are never compiled by the JVM; let Spark split such projections instead
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # the per-contract groupings follow a sort on the same keys: aggregate in order, without a hash map
    "spark.sql.execution.replaceHashWithSortAgg": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session somebody else created."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def get_session(app_name: str = "gotera", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or reuse) a session.

    On a cluster the master, memory and ``spark.checkpoint.dir`` come from spark-submit; ``master`` is for local use.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())
