"""Raw zone: monthly CSV or Parquet files of text columns."""

from __future__ import annotations

import functools
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from gotera.functions.text import snake_name
from gotera.operators.skew import broadcast_if_small
from gotera.sources.listing import month_of, raw_files

# The 63 bits of a CSV position: file of the month (16), megabyte at which the task's block starts (19, up to 512 GB a
# file), row inside the task (28). A Parquet position: file of the month (16), row of the file (47).
FILE_BITS, BLOCK_BITS, ROW_BITS = 16, 19, 28
Months = Iterable[tuple[int, int]]


def bare_path(path: Column) -> Column:
    """A path without its scheme, which Spark's columns spell in different ways."""
    return F.regexp_replace(path, "^[A-Za-z0-9+.-]+:/*", "/")


def file_ranks(files: DataFrame) -> DataFrame:
    """(bare path, rank): place of each file among those of its month, by path."""
    return files.select(bare_path(F.col("path")).alias("_file"), (F.row_number().over(
        Window.partitionBy("year", "month").orderBy("path")) - 1).cast("bigint").alias("_rank"))


def csv_position() -> Column:
    """Order of the rows inside one CSV file: the megabyte its block starts at, then the row inside the task.

    Blocks are planned on the driver and read in order, so a task that is run again gives its rows the same positions.
    """
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    block = F.shiftright(F.col("_metadata.file_block_start"), 20)
    return F.shiftleft(block, ROW_BITS) + inside


def wanted_files(spark: SparkSession, raw_dir: str, source: str, months: Months | None = None) -> DataFrame | None:
    files = raw_files(spark, raw_dir, source)
    if files is None or months is None:
        return files
    keys = [y * 100 + m for y, m in months]
    return files.where((F.col("year") * 100 + F.col("month")).isin(keys))


def csv_headers(spark: SparkSession, roots: list[str], options: dict) -> dict[tuple[str, ...], list[str]]:
    """The roots by the header of their first file; only that line is read."""
    def header(root: str) -> tuple[str, ...]:
        return tuple(spark.read.options(header="true", **options).csv(root).columns)

    with ThreadPoolExecutor(8) as pool:
        found = list(pool.map(header, roots))
    grouped: dict[tuple[str, ...], list[str]] = {}
    for root, columns in zip(roots, found):
        grouped.setdefault(columns, []).append(root)
    return grouped


def read_raw(
    spark: SparkSession,
    raw_dir: str,
    source: str,
    months: Months | None = None,
    file_format: str = "csv",
    **options: str,
) -> DataFrame | None:
    """Raw rows as text, with the month of the file in ``year`` and ``month`` and the row order in ``pos``.

    Months with equal headers are one scan; columns that a month lacks are null there. A month may be a folder of files:
    its rows are ordered by file path, then as in the file, so the order does not depend on how the month was cut. Files
    of one month with different headers are refused instead of misread.
    """
    files = wanted_files(spark, raw_dir, source, months)
    roots = [] if files is None else sorted(row["root"] for row in files.select("root").distinct().collect())
    if not roots:
        return None
    options = {"recursiveFileLookup": "true", **options}
    if file_format == "csv":
        parts = []
        for header, paths in csv_headers(spark, roots, options).items():
            schema = T.StructType([T.StructField(c, T.StringType(), True) for c in header])
            read = spark.read.schema(schema).options(header="true", enforceSchema="false", **options).csv(paths)
            parts.append(_named(read, source, csv_position()))
    elif file_format == "parquet":
        read = spark.read.options(mergeSchema="true", **options).parquet(*roots)
        parts = [_named(read, source, F.col("_metadata.row_index"))]
    else:
        raise ValueError(f"unsupported raw format: {file_format}")
    df = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    ranks = broadcast_if_small(file_ranks(files))
    far = F.col("_rank") >= (1 << FILE_BITS)
    rank = F.when(far, F.raise_error(F.lit(f"more than {1 << FILE_BITS} files in a month")).cast("bigint")).otherwise(F.col("_rank"))
    return df.join(ranks, "_file").withColumn("pos", F.shiftleft(rank, BLOCK_BITS + ROW_BITS) + F.col("pos")).drop("_file", "_rank")


def _named(df: DataFrame, source: str, pos: Column) -> DataFrame:
    month = month_of(F.col("_metadata.file_path"), source)
    return df.select(
        *[F.col(f"`{c}`").cast("string").alias(snake_name(c)) for c in df.columns],
        pos.alias("pos"), *[col.alias(name) for name, col in month.items()], bare_path(F.col("_metadata.file_path")).alias("_file"))
