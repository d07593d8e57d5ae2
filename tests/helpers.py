import datetime as dt

SCHEMA = (
    "contrato string, date date, consumo double, categoria string, estado string, determinacion_consumo string, "
    "instalacion string, subcategoria_estrato string, localidad string, municipio string, barrio string, "
    "microsector string, pos bigint, file_month int")


def rows(spark, data):
    """Consumption rows from dicts; unnamed attributes are null, file_month is the row's month."""
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    full = []
    for i, row in enumerate(data):
        date = row["date"] if isinstance(row["date"], dt.date) else dt.date.fromisoformat(row["date"])
        base = {"pos": i, "file_month": date.year * 100 + date.month, **row, "date": date}
        full.append(tuple(base.get(n) for n in names))
    return spark.createDataFrame(full, SCHEMA)


def as_set(df, *columns):
    return {tuple(r) for r in df.select(*columns).collect()}


def sorted_rows(df):
    names = sorted(df.columns)
    return sorted(repr(tuple(r)) for r in df.select(*[f"`{n}`" for n in names]).collect())
