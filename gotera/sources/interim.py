"""Interim zone: cleaned rows as Parquet, partitioned by the month of the raw file."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from gotera.operators.cutoffs import month_start
from gotera.schemas import INTERIM


def write_interim(df: DataFrame, interim_dir: str, source: str) -> None:
    """Replace exactly the months present in ``df``.

    The rebalance hint gives each month about one task and lets AQE split a month that is far larger than the others.
    """
    (
        df.hint("rebalance", "year", "month")
        .sortWithinPartitions("year", "month", "date", "pos")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("year", "month").parquet(f"{interim_dir}/{source}")
    )


def mark_empty_month(spark: SparkSession, interim_dir: str, source: str, year: int, month: int) -> None:
    """A raw month whose rows were all dropped still counts as processed: its partition becomes a file without rows."""
    schema = INTERIM[source]
    empty = spark.createDataFrame([], schema).drop("year", "month").coalesce(1)
    empty.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{interim_dir}/{source}/year={year}/month={month}")


def load_interim(
    spark: SparkSession,
    interim_dir: str,
    source: str,
    start: str | dt.date | None = None,
    end: str | dt.date | None = None,
) -> DataFrame:
    """Rows whose file month lies in [start, end]; the bounds prune partitions before anything is read.

    ``file_month`` (yyyymm) comes with the rows. A missing zone gives an empty result.
    """
    try:
        df = spark.read.schema(INTERIM[source]).parquet(f"{interim_dir}/{source}")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in (error.getCondition() or ""):
            raise
        df = spark.createDataFrame([], INTERIM[source])
    file_month = F.col("year") * 100 + F.col("month")
    for bound, inside in ((start, file_month.__ge__), (end, file_month.__le__)):
        if bound is not None:
            day = month_start(bound)
            df = df.where(inside(day.year * 100 + day.month))
    return df.withColumns({
        "file_month": file_month,
        "date": F.coalesce("date", F.make_date("year", "month", F.lit(1))),
    })
