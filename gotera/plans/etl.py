"""Monthly ETL: raw files to the interim zone, only the months that are due."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from gotera.operators.cleaning import CLEANERS
from gotera.sources.interim import mark_empty_month, write_interim
from gotera.sources.listing import interim_months, pending_months, raw_files
from gotera.sources.raw import Months, read_raw

SUMMARY = "source string, processed bigint, skipped bigint, total_pending bigint"


def ingest_months(
    spark: SparkSession, raw_dir: str, interim_dir: str, source: str, months: Months, file_format: str = "csv", **options
) -> int:
    """Clean the given months in one job and replace their interim partitions. Returns how many were written.

    A month without usable rows ends up as an empty partition, also where it had rows before.
    """
    wanted = sorted(set(months))
    raw = read_raw(spark, raw_dir, source, wanted, file_format, **options)
    if raw is None:
        return 0
    listed = lambda df: {(r["year"], r["month"]) for r in df.select("year", "month").distinct().collect()}
    cleaned = CLEANERS[source](raw)
    before = listed(interim_months(spark, interim_dir, source)) & set(wanted)
    write_interim(cleaned, interim_dir, source)
    filled = listed(cleaned) if before else listed(interim_months(spark, interim_dir, source))
    for year, month in wanted:
        if (year, month) not in filled:
            mark_empty_month(spark, interim_dir, source, year, month)
    return len(wanted)


def run_monthly_etl(
    spark: SparkSession,
    raw_dir: str,
    interim_dir: str,
    sources: Sequence[str] = ("inspecciones", "consumo"),
    overwrite: bool = False,
    file_format: str = "csv",
    **options,
) -> DataFrame:
    """Load every due month of every source; one summary row per source.

    Sources without a cleaner or without a raw folder are left out. ``overwrite`` takes all raw months again.
    """
    summary = []
    for source in sources:
        if source not in CLEANERS or raw_files(spark, raw_dir, source) is None:
            continue
        due = [(r["year"], r["month"]) for r in pending_months(spark, raw_dir, interim_dir, source, overwrite).collect()]
        processed = ingest_months(spark, raw_dir, interim_dir, source, due, file_format, **options) if due else 0
        summary.append((source, processed, len(due) - processed, len(due)))
    return spark.createDataFrame(summary, SUMMARY)
