"""The three entry points end to end: ETL, training, inference."""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from gotera.operators.cleaning import model_input
from gotera.plans.datasets import inference_dataset, train_dataset
from gotera.plans.etl import run_monthly_etl
from gotera.plans.model import (
    TARGET, TrainingSettings, check_features, contract_scores, load_model, save_model, search_params, train_model)
from gotera.schemas import DEFAULT_PERIODS
from gotera.sources.datasets import write_scores

# Fixed value: negatives drawn per cutoff in a training run.
MAX_NEGATIVES = 1500


def run_training(
    spark: SparkSession,
    interim_dir: str,
    processed_dir: str,
    model_dir: str,
    cutoff_max: str | None = None,
    n: int = DEFAULT_PERIODS,
    max_negatives: int | None = MAX_NEGATIVES,
    settings: TrainingSettings | None = None,
    search: bool = False,
) -> PipelineModel:
    """Training dataset, model-input gate, optional search, fit, save."""
    settings = settings or TrainingSettings()
    data = train_dataset(spark, interim_dir, processed_dir, n, cutoff_max, max_negatives)
    if data is None:
        raise ValueError("no training rows: load inspections and at least n months of consumption first")
    rows = model_input(data.withColumnRenamed("is_fraud", TARGET))
    if search:
        settings = replace(settings, params=search_params(rows, settings)[1])
    model = train_model(rows, settings)
    save_model(model, model_dir, settings.features)
    return model


def run_inference(
    spark: SparkSession,
    interim_dir: str,
    processed_dir: str,
    model_dir: str,
    predictions_dir: str,
    cutoff: str,
    n: int = DEFAULT_PERIODS,
    contracts: DataFrame | list[str] | None = None,
) -> DataFrame:
    """Inference dataset, model-input gate, scores, CSV. The allow-list is a table with ``contrato``, or a short list."""
    if isinstance(contracts, list):
        contracts = spark.createDataFrame([(c,) for c in contracts], "contrato string")
    data = inference_dataset(spark, interim_dir, processed_dir, cutoff, n, contracts)
    if data is None:
        raise ValueError(f"the {n} months before {cutoff} are not all loaded")
    rows = model_input(data)
    model, features = load_model(spark, model_dir)
    check_features(rows, features)
    scores = contract_scores(model, rows)
    path = write_scores(scores, predictions_dir, cutoff)
    return spark.read.schema("contrato string, score double").option("header", True).csv(path)


__all__ = ["run_inference", "run_monthly_etl", "run_training"]
