import datetime as dt
import os

import pytest
from helpers import as_set, sorted_rows
from pyspark.sql import functions as F

from gotera.plans import etl
from gotera.sources import datasets, interim, listing, raw
from gotera.streaming.etl_stream import start_interim_stream

HEADER = "NIU,Fecha mes,Consumo,Barrio"


@pytest.fixture
def zone(tmp_path):
    (tmp_path / "raw" / "consumo").mkdir(parents=True)
    return tmp_path


def put(zone, month, lines, header=HEADER):
    year, number = month
    path = zone / "raw" / "consumo" / f"consumo_{year}_{number:02d}.csv"
    path.write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")


def run(spark, zone, **options):
    done = etl.run_monthly_etl(spark, f"{zone}/raw", f"{zone}/interim", ["unknown", "inspecciones", "consumo"], **options)
    return [tuple(r) for r in done.collect()]


def months(df):
    return [tuple(r) for r in df.collect()]


def test_incremental_runs(spark, zone):
    put(zone, (2024, 1), ["a,202401,5,", "b,202401,-1,x"])
    put(zone, (2024, 2), ["a,202402,7,"])
    (zone / "raw" / "consumo" / "notes.txt").write_text("not a month")
    assert months(listing.pending_months(spark, f"{zone}/raw", f"{zone}/interim", "consumo")) == [(2024, 1), (2024, 2)]
    assert run(spark, zone) == [("consumo", 2, 0, 2)]
    assert run(spark, zone) == [("consumo", 0, 0, 0)]
    put(zone, (2024, 3), ["a,202403,8,"])
    put(zone, (2024, 1), ["a,202401,50,"])
    assert run(spark, zone) == [("consumo", 1, 0, 1)]
    loaded = interim.load_interim(spark, f"{zone}/interim", "consumo")
    assert as_set(loaded, "contrato", "consumo", "file_month", "barrio") == {
        ("a", 5.0, 202401, "sin_dato"), ("b", None, 202401, "x"), ("a", 7.0, 202402, "sin_dato"), ("a", 8.0, 202403, "sin_dato")}
    assert run(spark, zone, overwrite=True) == [("consumo", 3, 0, 3)]
    first = interim.load_interim(spark, f"{zone}/interim", "consumo", "2024-01-01", "2024-01-31")
    assert as_set(first, "contrato", "consumo") == {("a", 50.0)}
    bounds = listing.consumption_range(spark, f"{zone}/interim").head()
    assert tuple(bounds) == (dt.date(2024, 1, 1), dt.date(2024, 3, 1))
    assert months(listing.processed_months(spark, f"{zone}/interim", "consumo")) == [(2024, 1), (2024, 2), (2024, 3)]


def test_month_without_usable_rows_counts_as_processed(spark, zone):
    put(zone, (2024, 1), ["a,bad,5,"])
    assert run(spark, zone) == [("consumo", 1, 0, 1)] and run(spark, zone) == [("consumo", 0, 0, 0)]
    assert interim.load_interim(spark, f"{zone}/interim", "consumo").count() == 0


def test_positions_follow_the_file(spark, zone):
    put(zone, (2024, 1), [f"c{i},202401,{i},x" for i in range(2000)])
    loaded = raw.read_raw(spark, f"{zone}/raw", "consumo").orderBy("pos").select("niu").collect()
    assert [r["niu"] for r in loaded] == [f"c{i}" for i in range(2000)]


def test_months_with_other_headers(spark, zone):
    put(zone, (2024, 1), ["a,202401,5,x"])
    put(zone, (2024, 2), ["6,b,20242,y,E"], header="Consumo,NIU,Fecha mes,Barrio,Estado")
    assert run(spark, zone) == [("consumo", 2, 0, 2)]
    loaded = interim.load_interim(spark, f"{zone}/interim", "consumo")
    assert as_set(loaded, "contrato", "consumo", "barrio", "estado", "file_month") == {
        ("a", 5.0, "x", None, 202401), ("b", 6.0, "y", "E", 202402)}


def test_other_header_inside_a_month_is_refused(spark, zone):
    put(zone, (2024, 1), ["a,202401,5,x"])
    folder = zone / "raw" / "consumo" / "consumo_2024_01"
    folder.mkdir()
    (zone / "raw" / "consumo" / "consumo_2024_01.csv").rename(folder / "a.csv")
    (folder / "b.csv").write_text("Consumo,NIU,Fecha mes,Barrio\n5,a,202401,\n")
    with pytest.raises(Exception, match="(?i)header"):
        run(spark, zone)


@pytest.mark.parametrize("file_format", ["csv", "parquet"])
def test_positions_do_not_depend_on_the_files_of_a_month(spark, zone, file_format):
    rows = [(f"c{i}", "202401", str(i), "x") for i in range(60)]
    df = spark.createDataFrame(rows, "niu string, fecha_mes string, consumo string, barrio string")
    for month, parts in ((1, 1), (2, 5)):
        folder = f"{zone}/raw/consumo/consumo_2024_{month:02d}"
        df.coalesce(1).sortWithinPartitions(F.col("consumo").cast("int")).write.option("header", True).option(
            "maxRecordsPerFile", 60 // parts).format(file_format).save(folder)
    loaded = raw.read_raw(spark, f"{zone}/raw", "consumo", file_format=file_format)
    order = {m: [r["niu"] for r in loaded.where(F.col("month") == m).orderBy("pos").collect()] for m in (1, 2)}
    assert order[1] == order[2] == [f"c{i}" for i in range(60)]
    assert loaded.where("month = 2").select("pos").distinct().count() == 60


def test_overwrite_empties_a_month_that_lost_its_rows(spark, zone):
    put(zone, (2024, 1), ["a,202401,5,"])
    put(zone, (2024, 2), ["b,202402,6,"])
    run(spark, zone)
    put(zone, (2024, 1), ["a,bad,5,"])
    assert run(spark, zone, overwrite=True) == [("consumo", 2, 0, 2)]
    loaded = interim.load_interim(spark, f"{zone}/interim", "consumo")
    assert as_set(loaded, "contrato", "file_month") == {("b", 202402)}
    assert months(listing.processed_months(spark, f"{zone}/interim", "consumo")) == [(2024, 1), (2024, 2)]


def test_parquet_files(spark, zone):
    df = spark.createDataFrame([("a", "202401", "5")], "niu string, fecha_mes string, consumo string")
    df.write.parquet(f"{zone}/raw/consumo/consumo_2024_01.parquet")
    assert run(spark, zone, file_format="parquet") == [("consumo", 1, 0, 1)]
    assert interim.load_interim(spark, f"{zone}/interim", "consumo").count() == 1


def test_missing_zone(spark, tmp_path):
    assert interim.load_interim(spark, f"{tmp_path}/none", "consumo").count() == 0
    assert listing.consumption_range(spark, f"{tmp_path}/none").head()["first_month"] is None
    assert run(spark, tmp_path) == []


def test_stream_equals_batch(spark, zone):
    put(zone, (2024, 1), ["a,202401,5,", "b,202401,6,x"])
    target, ck = f"{zone}/streamed", f"{zone}/checkpoint"
    start_interim_stream(spark, f"{zone}/raw", target, "consumo", ck).awaitTermination()
    put(zone, (2024, 2), ["a,202402,7,"])
    start_interim_stream(spark, f"{zone}/raw", target, "consumo", ck).awaitTermination()
    run(spark, zone)
    assert sorted_rows(interim.load_interim(spark, target, "consumo")) == sorted_rows(
        interim.load_interim(spark, f"{zone}/interim", "consumo"))


def test_partition_pruning(spark, zone):
    put(zone, (2024, 1), ["a,202401,5,"])
    run(spark, zone)
    plan = interim.load_interim(spark, f"{zone}/interim", "consumo", "2024-01-01", "2024-02-01").select("contrato")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in text and "ReadSchema: struct<contrato:string>" in text


def test_dataset_and_scores(spark, tmp_path):
    df = spark.createDataFrame([("a", 0.25), ("b", 0.75)], "contrato string, score double")
    datasets.write_dataset(df, f"{tmp_path}/p", "train", "2024-01-01")
    datasets.write_dataset(df.limit(1), f"{tmp_path}/p", "train", "2024-02-01")
    assert datasets.read_dataset(spark, f"{tmp_path}/p", "train", "2024-01-01").count() == 2
    path = datasets.write_scores(df, f"{tmp_path}/s", "2024-01-01")
    assert any(n.endswith(".csv") for n in os.listdir(path))
    ranked = datasets.ranked_delivery(df.withColumn("pred_score", F.col("score")), "v7", ["contrato", "id_seleccion"])
    assert [tuple(r) for r in ranked.collect()] == [("b", "v7"), ("a", "v7")]
    with pytest.raises(ValueError):
        datasets.write_dataset(df, f"{tmp_path}/p", "other", "2024-01-01")
