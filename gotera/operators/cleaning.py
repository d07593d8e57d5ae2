"""Cleaning of the two monthly sources and of the model input. All narrow, except the label dedup (one shuffle)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from gotera.functions import text
from gotera.schemas import INTERIM, RAW_COLUMNS, REQUIRED_RAW

# Fixed values of the inspection classification.
UNDEFINED_RESULT = "Sin definición"
FRAUD_RESULTS = ["Fraude", "Anomalía"]
CONTRACT_LENGTH = 9
# Key columns of the raw sources and their common name.
CONTRACT_NAMES = {"servicio_suscrito": "contrato", "niu": "contrato"}
# Fixed values of the model-input gate.
GATE_STRINGS = ["categoria", "subcategoria_estrato", "municipio", "localidad", "barrio"]
MAX_NULL_MONTHS = 6
MAX_ZERO_MONTHS = 9


def normalized_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[text.snake_name(c) for c in df.columns])


def with_contract_name(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(CONTRACT_NAMES)


def expected_columns(df: DataFrame, source: str) -> DataFrame:
    """Raise on missing required columns, add missing optional ones as nulls."""
    missing = [c for c in REQUIRED_RAW[source] if c not in df.columns]
    if missing:
        raise ValueError(f"{source}: required columns missing: {missing}")
    return df.withColumns({
        c: F.lit(None).cast("string") for c in RAW_COLUMNS[source] if c not in df.columns})


def keep_length(df: DataFrame, column: str = "contrato", length: int = CONTRACT_LENGTH) -> DataFrame:
    return df.where(F.length(column) == length)


def with_month(df: DataFrame, source_column: str) -> DataFrame:
    """Add ``date`` (month start) from a yyyyMM text and drop rows where it is unusable."""
    return df.withColumn("date", text.month_date(F.col(source_column))).where(F.col("date").isNotNull())


def drop_undefined(df: DataFrame, column: str = "clasificacion_resultado") -> DataFrame:
    """Drop undefined results; a missing result stays."""
    return df.where(~F.col(column).eqNullSafe(UNDEFINED_RESULT))


def fraud_label(column: str = "clasificacion_resultado") -> Column:
    return F.coalesce(F.col(column).isin(FRAUD_RESULTS), F.lit(False)).cast("int")


def strongest_label(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ("pos",)) -> DataFrame:
    """Per key the first row (in ``order``) among those with the highest is_fraud: one shuffle, combined map-side."""
    earliest = [-F.col(c) for c in order]
    best = F.max_by(F.struct("*"), F.struct(F.col("is_fraud"), *earliest))
    kept = df.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys]).agg(best.alias("row"))
    # keys come from the grouping, so a reader of keys alone carries no rows through the shuffle
    return kept.select(*[F.col(f"_key_{c}" if c in keys else f"row.`{c}`").alias(c) for c in df.columns])


def clean_inspections(raw: DataFrame) -> DataFrame:
    """Raw inspections (text columns, plus ``pos`` and the file's ``year`` and ``month``) to interim rows."""
    df = expected_columns(normalized_columns(raw), "inspecciones")
    df = with_contract_name(df).withColumn("contrato", text.trimmed(F.col("contrato")))
    df = drop_undefined(with_month(keep_length(df), "fecha")).withColumn("is_fraud", fraud_label())
    df = df.select(*INTERIM["inspecciones"].names)
    return strongest_label(df, ["contrato", "date", "year", "month"])


def clean_consumption(raw: DataFrame) -> DataFrame:
    """Raw consumption (text columns, plus ``pos`` and the file's ``year`` and ``month``) to interim rows."""
    df = with_contract_name(expected_columns(normalized_columns(raw), "consumo"))
    plain = ["contrato", "instalacion", "subcategoria_estrato", "localidad", "municipio", "determinacion_consumo"]
    df = df.withColumns({
        **{c: text.trimmed(F.col(c)) for c in plain},
        "barrio": text.trimmed_or_missing(F.col("barrio")),
        "consumo": text.non_negative(F.col("consumo")),
    })
    df = with_month(df, "fecha_mes").where(F.col("contrato").isNotNull())
    return df.select(*INTERIM["consumo"].names)


CLEANERS = {"inspecciones": clean_inspections, "consumo": clean_consumption}


def unique_labels(labels: DataFrame) -> DataFrame:
    """One inspection per contract and month over all files; the earlier file wins ties."""
    return strongest_label(labels, ["contrato", "date"], ["year", "month", "pos"])


def fill_strings(df: DataFrame, columns: Iterable[str], value: str) -> DataFrame:
    return df.fillna(value, subset=list(columns))


def fill_numbers(df: DataFrame, columns: Iterable[str], value: float) -> DataFrame:
    return df.fillna(value, subset=list(columns))


def model_input(
    df: DataFrame, max_null_months: int = MAX_NULL_MONTHS, max_zero_months: int = MAX_ZERO_MONTHS
) -> DataFrame:
    """Categories without nulls, and only contracts with enough readings and not too many zeros."""
    return df.withColumns({c: text.trimmed_or_missing(F.col(c)) for c in GATE_STRINGS}).where(
        (F.col("cant_null") < max_null_months) & (F.col("cant_ceros_12") < max_zero_months))
