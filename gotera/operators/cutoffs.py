"""Cutoff months: validation, window bounds, the valid list, and assigning rows to the windows of many cutoffs.

A window is ``[cutoff - n months, cutoff)``. There is at most one cutoff per calendar month, which bounds every list of
cutoffs (and the broadcasts of them) by the length of the calendar, not by the data.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from gotera.operators.skew import broadcast_if_small
from gotera.schemas import DEFAULT_PERIODS

# Contracts with their asked cutoffs are broadcast up to this many: a row holds a list of months.
ASKED_ROWS = 500_000


def month_start(value: str | dt.date) -> dt.date:
    """Month start of a ``YYYY-MM-DD`` text or a date."""
    if isinstance(value, str):
        if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", value.strip()):
            raise ValueError(f"a cutoff must look like YYYY-MM-DD, got {value!r}")
        value = dt.date.fromisoformat(value.strip())
    if value is None:
        raise ValueError("a cutoff is required")
    return dt.date(value.year, value.month, 1)


def shift_months(day: dt.date, months: int) -> dt.date:
    count = day.year * 12 + day.month - 1 + months
    return dt.date(count // 12, count % 12 + 1, 1)


def window_bounds(cutoff: str | dt.date, n: int = DEFAULT_PERIODS) -> tuple[dt.date, dt.date]:
    end = month_start(cutoff)
    return shift_months(end, -n), end


def cutoff_list(cutoffs: Iterable[str | dt.date]) -> list[dt.date]:
    return sorted({month_start(c) for c in cutoffs})


def cutoff_frame(spark: SparkSession, cutoffs: Sequence[dt.date]) -> DataFrame:
    return spark.createDataFrame([(c,) for c in cutoffs], "cutoff date")


def window_months(cutoff: Column, n: int = DEFAULT_PERIODS) -> Column:
    """The n months of a window as an array of dates, oldest first."""
    return F.sequence(F.add_months(cutoff, -n), F.add_months(cutoff, -1), F.expr("interval 1 month"))


def valid_cutoffs(
    labels: DataFrame,
    first_month: Column | dt.date,
    n: int = DEFAULT_PERIODS,
    last: str | dt.date | None = None,
) -> DataFrame:
    """Months with inspections that have n months of consumption history before them, sorted."""
    first = first_month if isinstance(first_month, Column) else F.lit(first_month)
    months = labels.select(F.trunc("date", "MM").alias("cutoff")).where(F.col("cutoff") >= F.add_months(first, n))
    if last is not None:
        months = months.where(F.col("cutoff") <= F.lit(month_start(last)))
    return months.distinct().orderBy("cutoff")


def valid_cutoffs_from_consumption(
    labels: DataFrame, rows: DataFrame, n: int = DEFAULT_PERIODS, last: str | dt.date | None = None
) -> DataFrame:
    """Same, with the first month taken from the consumption table (one row brought back)."""
    first = rows.agg(F.min("date").alias("first")).head()["first"]
    return valid_cutoffs(labels, first if first else F.lit(None).cast("date"), n, last)


def months_back(cutoff: Column, date: Column) -> Column:
    """1 for the month just before the cutoff, n for the oldest month of the window."""
    return (F.year(cutoff) - F.year(date)) * 12 + F.month(cutoff) - F.month(date)


def within_reach(rows: DataFrame, cutoffs: Sequence[dt.date], n: int = DEFAULT_PERIODS) -> DataFrame:
    """Only rows some window can use. The range predicate is on the date and, where present, on the file month."""
    low, high = shift_months(cutoffs[0], -n), cutoffs[-1]
    return rows.where((F.col("date") >= F.lit(low)) & (F.col("date") < F.lit(high)))


def slice_windows(rows: DataFrame, cutoffs: Sequence[dt.date], n: int = DEFAULT_PERIODS) -> DataFrame:
    """Add ``cutoff`` and ``k`` (months back), one row per window the row falls into.

    One cutoff is a plain filter. Several cutoffs are an explode of the n offsets and an equi-join with the broadcast
    cutoff list, so there is no nested-loop range join; the partitioning of the input is kept.
    """
    rows = within_reach(rows, cutoffs, n)
    if len(cutoffs) == 1:
        only = F.lit(cutoffs[0])
        return rows.withColumns({"cutoff": only, "k": months_back(only, F.col("date"))})
    frame = F.broadcast(cutoff_frame(rows.sparkSession, cutoffs))
    return (
        rows.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(n))))
        .withColumn("cutoff", F.add_months("date", F.col("k")))
        .join(frame, "cutoff")
    )


def slice_asked(
    rows: DataFrame, asked: DataFrame, cutoffs: Sequence[dt.date], n: int = DEFAULT_PERIODS, max_rows: int = ASKED_ROWS
) -> DataFrame:
    """``slice_windows`` of the windows that ``asked`` (contrato, cutoff) names, and of no others.

    Rows meet the asked cutoffs of their contract first and are repeated after that, so each row is shuffled once, or not at
    all where few contracts are asked for.
    """
    rows = within_reach(rows, cutoffs, n)
    if len(cutoffs) > 1:
        # windows of several cutoffs hold whole months, so dates that are no month start are in none
        rows = rows.where(F.col("date") == F.trunc("date", "MM"))
    per_contract = asked.where(F.col("cutoff").isin(list(cutoffs))).groupBy("contrato").agg(
        F.collect_set("cutoff").alias("_asked"))
    covering = F.filter("_asked", lambda c: (F.col("date") < c) & (F.col("date") >= F.add_months(c, -n)))
    met = rows.join(broadcast_if_small(per_contract, max_rows), "contrato").withColumn("cutoff", F.explode(covering))
    return met.drop("_asked").withColumn("k", months_back(F.col("cutoff"), F.col("date")))


def month_number(date: Column) -> Column:
    return F.year(date) * 12 + F.month(date)


def months_opened(keys: Sequence[str], n: int = DEFAULT_PERIODS) -> Column:
    """How many months ahead a row's month opens windows (``opened_months``), as the numbers 1 to that."""
    here = month_number(F.col("date"))
    following = F.lead(here).over(Window.partitionBy(*keys).orderBy("date"))
    return F.sequence(F.lit(1), F.least(F.lit(n), F.coalesce(following - here, F.lit(n))))


def opened_months(keys: Sequence[str], n: int = DEFAULT_PERIODS) -> Column:
    """The cutoffs whose windows a row's month opens, of rows with one ``date`` per key and month.

    A month opens the windows of the months after it up to n on, but not beyond the key's next month, which opens the
    later ones itself. So a key with a row in every month opens one window per month, not n.
    """
    return F.transform(months_opened(keys, n), lambda k: F.add_months("date", k))


def windows_opened(months: DataFrame, keys: Sequence[str], cutoffs: Sequence[dt.date], n: int = DEFAULT_PERIODS) -> DataFrame:
    """(keys, cutoff): each window of ``cutoffs`` in which a key has a month, once; ``months`` holds a row per key and
    month. One sort by key and month; the partitioning of the input by key is kept."""
    opened = months.withColumn("_ahead", months_opened(keys, n)).select(*keys, "date", F.explode("_ahead").alias("_ahead"))
    windows = opened.select(*keys, F.add_months("date", F.col("_ahead")).alias("cutoff"))
    return windows.where(F.col("cutoff").isin(list(cutoffs)))


def month_count(rows: DataFrame, cutoff: dt.date, n: int = DEFAULT_PERIODS) -> DataFrame:
    """Distinct months with rows inside the window (the completeness check compares it with n)."""
    return within_reach(rows, [cutoff], n).agg(F.countDistinct("date").alias("months"))
