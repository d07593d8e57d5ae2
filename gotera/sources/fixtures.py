"""Consumption and inspection views over the star-schema test tables (mapping in FIXTURES.md)."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gotera.schemas import LABEL

# ``pos`` packs (l_orderkey, low bits of l_partkey); a run of 2**20 order keys is one chunk.
PART_BITS = 25
CHUNK_BITS = PART_BITS + 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def spread_out(df: DataFrame, key: str) -> DataFrame:
    """Hash-partition a table whose files split into fewer tasks than there are cores; larger tables stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def _joined(spark: SparkSession, sf_dir: str, where: Column | None = None) -> DataFrame:
    """Line items with their order priority and the supplier's place.

    No hints: Spark broadcasts the tables whose files are below its own threshold and sort-merges the others.
    """
    items = spread_out(table(spark, sf_dir, "lineitem"), "l_orderkey")
    if where is not None:
        items = items.where(where)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    regions = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (
        items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    )


def _contract() -> Column:
    return F.lpad((F.col("l_suppkey") * 10 + F.col("l_linenumber")).cast("string"), 9, "0")


def _position() -> Column:
    low = F.col("l_partkey").bitwiseAND(F.lit((1 << PART_BITS) - 1))
    return F.shiftleft("l_orderkey", PART_BITS) + low


def _month() -> Column:
    return F.trunc("l_shipdate", "MM")


def consumption(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned consumption rows, shaped like an interim read."""
    level = F.floor(F.col("l_quantity") / 10) - 1
    return _joined(spark, sf_dir).select(
        _contract().alias("contrato"),
        _month().alias("date"),
        F.when(level >= 0, level.cast("double")).alias("consumo"),
        F.when(F.col("l_tax") != 0.08, F.col("l_returnflag")).alias("categoria"),
        F.col("l_linestatus").alias("estado"),
        F.col("l_linenumber").cast("string").alias("microsector"),
        F.col("l_suppkey").cast("string").alias("instalacion"),
        F.col("s_nationkey").cast("string").alias("subcategoria_estrato"),
        F.col("n_name").alias("localidad"),
        F.col("r_name").alias("municipio"),
        F.col("o_orderpriority").alias("determinacion_consumo"),
        F.when(F.col("s_acctbal") >= 0, F.col("n_name")).alias("barrio"),
        _position().alias("pos"),
        (F.year("l_shipdate") * 100 + F.month("l_shipdate")).alias("file_month"),
    )


def _classification() -> Column:
    priority = F.col("o_orderpriority")
    return (
        F.when(priority == "1-URGENT", "Fraude").when(priority == "2-HIGH", "Anomalía")
        .when(priority == "3-MEDIUM", "Sin definición").when(priority == "5-LOW", "Normal")
    )


def raw_inspections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inspections as raw text rows, some of them unusable: short contract ids and impossible months."""
    rows = _joined(spark, sf_dir, F.col("l_discount").isin(0.1, 0.09, 0.08)).withColumn("contract", _contract())
    month = F.date_format("l_shipdate", "yyyyMM")
    return rows.select(
        F.when(F.col("l_discount") == 0.09, F.substring("contract", 2, 8)).otherwise(
            F.concat(F.lit(" "), F.col("contract"), F.lit("  "))).alias("servicio_suscrito"),
        F.when(F.col("l_discount") == 0.08, F.concat(F.year("l_shipdate").cast("string"), F.lit("13")))
        .otherwise(month).alias("fecha"),
        _classification().alias("clasificacion_resultado"),
        F.col("l_orderkey").cast("string").alias("solicitud"),
        F.col("l_suppkey").cast("string").alias("instalacion"),
        F.col("l_returnflag").alias("resultado"),
        F.col("l_linestatus").alias("causa_de_revision"),
        _position().alias("pos"),
        F.year("l_shipdate").alias("year"),
        F.month("l_shipdate").alias("month"),
    )


def inspections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned inspections: one labelled row per contract and month."""
    from gotera.operators.cleaning import clean_inspections

    usable = raw_inspections(spark, sf_dir).where(F.length(F.trim("servicio_suscrito")) == 9)
    return clean_inspections(usable).select("contrato", "date", *LABEL, "pos", "year", "month")


def raw_consumption(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consumption as raw text rows: untrimmed, negative readings, and a copy of some rows with an unusable month."""
    rows = _joined(spark, sf_dir)
    copies = F.when(F.col("l_discount") == 0, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    rows = rows.withColumn("broken", F.explode(copies))

    def padded(col: Column) -> Column:
        return F.concat(F.lit(" "), col, F.lit(" "))

    return rows.select(
        padded(_contract()).alias("niu"),
        F.when(F.col("broken"), F.date_format("l_shipdate", "yyyy-MM"))
        .otherwise(F.date_format("l_shipdate", "yyyyMM")).alias("fecha_mes"),
        (F.floor(F.col("l_quantity") / 10) - 1).cast("string").alias("consumo"),
        F.when(F.col("l_tax") != 0.08, F.col("l_returnflag")).alias("categoria"),
        F.col("l_linestatus").alias("estado"),
        F.col("l_linenumber").cast("string").alias("microsector"),
        padded(F.col("l_suppkey").cast("string")).alias("instalacion"),
        padded(F.col("s_nationkey").cast("string")).alias("subcategoria_estrato"),
        padded(F.col("n_name")).alias("localidad"),
        padded(F.col("r_name")).alias("municipio"),
        padded(F.col("o_orderpriority")).alias("determinacion_consumo"),
        F.when(F.col("s_acctbal") >= 0, padded(F.col("n_name"))).alias("barrio"),
        _position().alias("pos"),
        F.year("l_shipdate").alias("year"),
        F.month("l_shipdate").alias("month"),
    )
