"""Month listings of the raw and interim zones, read from file paths only (no file content)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

MONTHS = "year int, month int"


def month_pattern(source: str) -> str:
    """A file or folder named <source>_YYYY_MM, alone or as the value of a partition folder."""
    return rf"[/=]{source}_(\d{{4}})_(\d{{2}})(?:[./]|$)"


def listed_files(spark: SparkSession, folder: str, glob: str | None = None, **options: str) -> DataFrame | None:
    """Paths below a folder, or None when it does not exist. The content column is never selected, so never read."""
    reader = spark.read.format("binaryFile").options(**options)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    try:
        return reader.load(folder)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in (error.getCondition() or ""):
            return None
        raise


def month_of(path, source: str):
    pattern = month_pattern(source)
    return {
        "year": F.regexp_extract(path, pattern, 1).try_cast("int"),
        "month": F.regexp_extract(path, pattern, 2).try_cast("int"),
    }


def raw_files(spark: SparkSession, raw_dir: str, source: str) -> DataFrame | None:
    """(path, root, year, month) of the raw files of a source; the root is the file or folder that carries the month."""
    files = listed_files(spark, f"{raw_dir}/{source}", recursiveFileLookup="true")
    if files is None:
        return None
    root = F.regexp_extract("path", rf"^(.*[/=]{source}_\d{{4}}_\d{{2}}[^/]*)", 1)
    return files.select("path", root.alias("root"), *[c.alias(n) for n, c in month_of(F.col("path"), source).items()]).where(
        F.col("year").isNotNull())


def raw_months(spark: SparkSession, raw_dir: str, source: str) -> DataFrame:
    files = raw_files(spark, raw_dir, source)
    if files is None:
        return spark.createDataFrame([], MONTHS)
    return files.select("year", "month").distinct()


def interim_months(spark: SparkSession, interim_dir: str, source: str) -> DataFrame:
    """Months already in the interim zone, from the partition folders."""
    files = listed_files(spark, f"{interim_dir}/{source}", "*.parquet")
    if files is None or "year" not in files.columns:
        return spark.createDataFrame([], MONTHS)
    return files.select(F.col("year").cast("int"), F.col("month").cast("int")).distinct()


def processed_months(spark: SparkSession, interim_dir: str, source: str) -> DataFrame:
    return interim_months(spark, interim_dir, source).orderBy("year", "month")


def pending_months(
    spark: SparkSession, raw_dir: str, interim_dir: str, source: str, overwrite: bool = False
) -> DataFrame:
    """Raw months without an interim partition; all raw months when overwriting."""
    months = raw_months(spark, raw_dir, source)
    if not overwrite:
        months = months.join(interim_months(spark, interim_dir, source), ["year", "month"], "left_anti")
    return months.orderBy("year", "month")


def consumption_range(spark: SparkSession, interim_dir: str) -> DataFrame:
    """First and last consumption month, from the partition folders alone."""
    date = F.make_date("year", "month", F.lit(1))
    return interim_months(spark, interim_dir, "consumo").agg(
        F.min(date).alias("first_month"), F.max(date).alias("last_month"))
