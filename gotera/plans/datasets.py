"""Interim zone to processed datasets: training rows of many cutoffs, inference rows of one."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from gotera.functions.features import consumption_features
from gotera.operators.cleaning import unique_labels
from gotera.operators.cutoffs import month_count, month_start, valid_cutoffs, window_bounds
from gotera.operators.wide import inference_wide, train_wide, wide_columns
from gotera.schemas import DEFAULT_PERIODS
from gotera.sources.datasets import read_dataset, write_dataset
from gotera.sources.interim import load_interim
from gotera.sources.listing import consumption_range


def featured(wide: DataFrame, n: int = DEFAULT_PERIODS) -> DataFrame:
    return wide_columns(consumption_features(wide, n), n)


def training_cutoffs(
    spark: SparkSession, interim_dir: str, n: int = DEFAULT_PERIODS, last: str | dt.date | None = None
) -> list[dt.date]:
    """Cutoffs with inspections and enough history; at most one per calendar month, so they fit the driver."""
    labels = load_interim(spark, interim_dir, "inspecciones")
    first = consumption_range(spark, interim_dir).head()["first_month"]
    if first is None:
        return []
    return [r["cutoff"] for r in valid_cutoffs(labels, first, n, last).collect()]


def train_dataset(
    spark: SparkSession,
    interim_dir: str,
    processed_dir: str,
    n: int = DEFAULT_PERIODS,
    cutoff_max: str | dt.date | None = None,
    max_negatives: int | None = None,
) -> DataFrame | None:
    """Build, store and return the training rows of all valid cutoffs up to ``cutoff_max``; None when there are none."""
    cutoffs = training_cutoffs(spark, interim_dir, n, cutoff_max)
    if not cutoffs:
        return None
    labels = unique_labels(load_interim(spark, interim_dir, "inspecciones"))
    rows = load_interim(spark, interim_dir, "consumo", window_bounds(cutoffs[0], n)[0], cutoffs[-1])
    name = month_start(cutoff_max) if cutoff_max is not None else cutoffs[-1]
    write_dataset(featured(train_wide(rows, labels, cutoffs, n, max_negatives), n), processed_dir, "train", name)
    return read_dataset(spark, processed_dir, "train", name)


def inference_dataset(
    spark: SparkSession,
    interim_dir: str,
    processed_dir: str,
    cutoff: str | dt.date,
    n: int = DEFAULT_PERIODS,
    contracts: DataFrame | None = None,
) -> DataFrame | None:
    """Build, store and return the rows to score at a cutoff; None unless each of the n months has rows.

    ``contracts`` (column contrato) limits the scored contracts. A cutoff after the last loaded month is allowed as long
    as its window is complete.
    """
    start, end = window_bounds(cutoff, n)
    rows = load_interim(spark, interim_dir, "consumo", start, end)
    if month_count(rows, end, n).head()["months"] < n:
        return None
    write_dataset(featured(inference_wide(rows, end, n, contracts), n), processed_dir, "inference", end)
    return read_dataset(spark, processed_dir, "inference", end)
