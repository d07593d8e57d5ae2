"""Processed datasets and score deliveries."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from gotera.operators.cutoffs import month_start

MODES = ("train", "inference")


def _check_mode(mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")


def write_dataset(df: DataFrame, processed_dir: str, mode: str, cutoff: str | dt.date) -> None:
    """Write a dataset under <processed>/<mode>/cutoff=YYYY-MM-DD, replacing only that cutoff."""
    _check_mode(mode)
    (
        df.withColumn("cutoff", F.lit(month_start(cutoff).isoformat()))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("cutoff").parquet(f"{processed_dir}/{mode}")
    )


def read_dataset(spark: SparkSession, processed_dir: str, mode: str, cutoff: str | dt.date) -> DataFrame:
    _check_mode(mode)
    df = spark.read.parquet(f"{processed_dir}/{mode}")
    return df.where(F.col("cutoff") == F.lit(month_start(cutoff))).drop("cutoff")


def write_scores(scores: DataFrame, predictions_dir: str, cutoff: str | dt.date) -> str:
    """Scores (contrato, score) as CSV under scores_<cutoff>."""
    path = f"{predictions_dir}/scores_{month_start(cutoff).isoformat()}"
    scores.select("contrato", "score").write.mode("overwrite").option("header", True).csv(path)
    return path


def ranked_delivery(
    scored: DataFrame, selection: str, columns: Sequence[str], score: str = "pred_score", key: str = "contrato"
) -> DataFrame:
    """Tag scored rows with a selection id and put the highest scores first.

    The sort is range-partitioned; the key after the score lets a score shared by very many rows spread over tasks.
    """
    tagged = scored.withColumn("id_seleccion", F.lit(selection))
    return tagged.orderBy(F.desc(score), key).select(*columns)


def write_ranked_delivery(
    scored: DataFrame, selection: str, columns: Sequence[str], path: str, score: str = "pred_score"
) -> None:
    ranked_delivery(scored, selection, columns, score).write.mode("overwrite").option("header", True).csv(path)
