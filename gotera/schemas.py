"""Column lists and schemas shared by the sources, operators and plans."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw column names (after name normalising) the two monthly sources carry.
RAW_COLUMNS = {
    "inspecciones": [
        "servicio_suscrito", "fecha", "clasificacion_resultado",
        "solicitud", "instalacion", "resultado", "causa_de_revision",
    ],
    "consumo": [
        "niu", "fecha_mes", "consumo", "categoria", "estado", "microsector", "instalacion",
        "subcategoria_estrato", "localidad", "municipio", "determinacion_consumo", "barrio",
    ],
}

REQUIRED_RAW = {
    "inspecciones": ["servicio_suscrito", "fecha", "clasificacion_resultado"],
    "consumo": ["niu", "fecha_mes", "consumo"],
}


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


_S = T.StringType()

# Interim rows. ``pos`` orders the rows of one file; year and month are the month of the file.
INTERIM = {
    "inspecciones": _schema(
        ("contrato", _S), ("date", T.DateType()), ("is_fraud", T.IntegerType()),
        ("clasificacion_resultado", _S), ("solicitud", _S), ("instalacion", _S),
        ("resultado", _S), ("causa_de_revision", _S), ("pos", T.LongType()),
        ("year", T.IntegerType()), ("month", T.IntegerType()),
    ),
    "consumo": _schema(
        ("contrato", _S), ("date", T.DateType()), ("consumo", T.DoubleType()),
        ("categoria", _S), ("estado", _S), ("microsector", _S), ("instalacion", _S),
        ("subcategoria_estrato", _S), ("localidad", _S), ("municipio", _S),
        ("determinacion_consumo", _S), ("barrio", _S), ("pos", T.LongType()),
        ("year", T.IntegerType()), ("month", T.IntegerType()),
    ),
}

# Attributes whose changes are counted, attributes taken from the latest row, and label columns.
TRACKED = ["categoria", "estado", "determinacion_consumo"]

# Attributes taken from the latest row of a contract inside the window.
STATIC = [
    "instalacion", "estado", "categoria", "subcategoria_estrato",
    "localidad", "municipio", "barrio", "microsector",
]

# Label columns a training row carries.
LABEL = ["is_fraud", "solicitud", "instalacion", "resultado", "clasificacion_resultado", "causa_de_revision"]

DEFAULT_PERIODS = 12


def period_columns(n: int = DEFAULT_PERIODS) -> list[str]:
    """Names of the monthly columns, oldest month first."""
    return [f"{k}_anterior" for k in range(n, 0, -1)]
