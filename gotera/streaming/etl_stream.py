"""Incremental ETL as a file-source stream: new raw files trigger the load of their months.

The stream carries file names only. A month is always loaded from all its raw files, so a batch that is run again, or a
month whose files arrive in several batches, ends in the same interim partition as the batch ETL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from gotera.plans.etl import ingest_months
from gotera.sources.listing import month_of

BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def start_interim_stream(
    spark: SparkSession,
    raw_dir: str,
    interim_dir: str,
    source: str,
    checkpoint: str,
    file_format: str = "csv",
    **options,
) -> StreamingQuery:
    """Start an available-now stream for one source; ``checkpoint`` remembers the files already seen."""
    def load(batch: DataFrame, _: int) -> None:
        months = [(r["year"], r["month"]) for r in batch.distinct().collect()]
        if months:
            ingest_months(batch.sparkSession, raw_dir, interim_dir, source, months, file_format, **options)

    files = (
        spark.readStream.format("binaryFile").schema(BINARY_FILE)
        .option("recursiveFileLookup", "true").load(f"{raw_dir}/{source}")
    )
    months = files.select("path").withColumns(month_of(F.col("path"), source)).select("year", "month")
    return (
        months.where(F.col("year").isNotNull()).writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
