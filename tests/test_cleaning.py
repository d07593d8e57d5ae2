import datetime as dt

import pytest
from pyspark.sql import functions as F

from gotera.functions import text
from gotera.operators import cleaning

RAW = "servicio_suscrito string, fecha string, clasificacion_resultado string, pos bigint, year int, month int"
MONTH = "202401"


def inspections(spark, data):
    return {tuple(r) for r in cleaning.clean_inspections(spark.createDataFrame(
        [(*row, i, 2024, 1) for i, row in enumerate(data)], RAW)).select("contrato", "date", "is_fraud", "pos").collect()}


def test_names():
    assert text.snake_name("Causa de-Revisión") == "causa_derevision"
    assert text.snake_name("  Año  (mes) ") == "ano_mes" and text.snake_name(7) == "7"


def test_name_normaliser_on_values_agrees_with_the_one_on_names(spark):
    samples = ["Causa de-Revisión", "ÑANDÚ  ÇA", "a\tb", "x_y!", "", "Ŝěř 12"]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    assert [r[0] for r in df.select(text.snake_text(F.col("s"))).collect()] == [text.snake_name(s) for s in samples]


def test_month_parse(spark):
    df = spark.createDataFrame([(v,) for v in ("202401", "202413", "2024-01", None, " 202402 ", "2024011", "20243", "20240")], "v string")
    assert [r[0] for r in df.select(text.month_date(F.col("v"))).collect()] == [
        dt.date(2024, 1, 1), None, None, None, dt.date(2024, 2, 1), None, dt.date(2024, 3, 1), None]


def test_measure(spark):
    df = spark.createDataFrame([(v,) for v in ("3.5", "-1", "0", None, "x", "NaN")], "v string")
    assert [r[0] for r in df.select(text.non_negative(F.col("v"))).collect()] == [3.5, None, 0.0, None, None, None]


def test_inspections(spark):
    out = inspections(spark, [
        (" 123456789 ", MONTH, "Normal"), ("123456789", MONTH, "Fraude"), ("123456789", MONTH, "Anomalía"),
        ("12345678", MONTH, "Fraude"), ("111111111", "202413", "Fraude"), ("222222222", MONTH, "Sin definición"),
        ("333333333", MONTH, None), (None, MONTH, "Fraude")])
    day = dt.date(2024, 1, 1)
    assert out == {("123456789", day, 1, 1), ("333333333", day, 0, 6)}


def test_dedup_over_files_prefers_the_earlier_file(spark):
    data = [("c", dt.date(2024, 1, 1), 1, 9, 2024, 1), ("c", dt.date(2024, 1, 1), 1, 1, 2024, 2)]
    df = spark.createDataFrame(data, "contrato string, date date, is_fraud int, pos bigint, year int, month int")
    assert [r["pos"] for r in cleaning.unique_labels(df).collect()] == [9]


def test_consumption_keeps_real_nulls_and_adds_missing_columns(spark):
    data = [(" 1 ", MONTH, "-2", " N ", None, 0, 2024, 1), (None, MONTH, "1", None, None, 1, 2024, 1),
            ("2", "bad", "1", None, "x", 2, 2024, 1)]
    raw = spark.createDataFrame(
        data, "NIU string, `Fecha mes` string, consumo string, localidad string, barrio string, pos bigint, year int, month int")
    row = cleaning.clean_consumption(raw).collect()
    assert len(row) == 1
    assert row[0]["contrato"] == "1" and row[0]["consumo"] is None and row[0]["localidad"] == "N"
    assert row[0]["barrio"] == "sin_dato" and row[0]["municipio"] is None and row[0]["categoria"] is None


def test_required_columns(spark):
    with pytest.raises(ValueError, match="consumo"):
        cleaning.clean_consumption(spark.createDataFrame([("1", MONTH)], "niu string, fecha_mes string"))


def test_model_input(spark):
    data = [("A ", None, 5, 8), ("B", "x", 6, 0), ("C", "y", 0, 9)]
    df = spark.createDataFrame(data, "categoria string, barrio string, cant_null int, cant_ceros_12 int")
    for c in ("subcategoria_estrato", "municipio", "localidad"):
        df = df.withColumn(c, F.lit("z"))
    out = cleaning.model_input(df).collect()
    assert [(r["categoria"], r["barrio"]) for r in out] == [("A", "sin_dato")]


def test_zone_code(spark):
    df = spark.createDataFrame([("zona peligrosa",), ("zona no peligrosa",), ("otra",), (None,)], "z string")
    assert [r[0] for r in df.select(text.danger_zone_code(F.col("z"))).collect()] == [1, 0, None, None]


def test_a_reader_of_label_keys_carries_no_rows(spark):
    raw = spark.createDataFrame(
        [("a", None, 1, 2, "x"), ("a", None, 1, 1, "y"), ("b", "k", 0, 3, "z")], "c string, d string, is_fraud int, pos int, v string")
    kept = cleaning.strongest_label(raw, ["c", "d"])
    assert kept.columns == raw.columns
    assert {tuple(r) for r in kept.collect()} == {("a", None, 1, 1, "y"), ("b", "k", 0, 3, "z")}
    assert "max_by" not in kept.select("d").distinct()._jdf.queryExecution().executedPlan().toString()
