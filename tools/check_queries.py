"""Compare registered queries with their SQL in DuckDB: python tools/check_queries.py <sf_dir> [name ...]"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gotera import catalog, oracles  # noqa: E402
from gotera.session import get_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normal(rows: list, columns: list[str]) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def compare(spark, con, sf_dir: str, name: str) -> tuple[bool, str]:
    start = time.time()
    df = catalog.queries()[name](spark, sf_dir)
    mine = [tuple(r) for r in df.collect()]
    spent = time.time() - start
    sql = oracles.oracle_sql().get(name)
    if sql is None:
        return True, f"{len(mine)} rows, no SQL, {spent:.1f}s"
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    theirs = result.fetchall()
    if sorted(columns) != sorted(df.columns):
        return False, f"columns differ: {sorted(set(columns) ^ set(df.columns))}"
    names = {"bigint": ("BIGINT", "NUMBER"), "double": ("DOUBLE", "NUMBER"), "string": ("VARCHAR", "STRING"),
             "date": ("DATE", "Date"), "boolean": ("BOOLEAN", "bool")}
    odd = [(c, t, kinds[c]) for c, t in df.dtypes if kinds[c] not in names.get(t, ())]
    left, right = normal(mine, df.columns), normal(theirs, columns)
    if left != right:
        only_left, only_right = sorted(set(left) - set(right)), sorted(set(right) - set(left))
        columns_sorted = sorted(columns)
        shown = f"{len(mine)} vs {len(theirs)} rows, {len(only_left)} / {len(only_right)} differ"
        for l, r in list(zip(only_left, only_right))[:2]:
            a, b = eval(l, {"datetime": __import__("datetime")}), eval(r, {"datetime": __import__("datetime")})
            diff = [(c, x, y) for c, x, y in zip(columns_sorted, a, b) if x != y]
            shown += f"\n     {str(diff)[:600]}"
        return False, shown
    return True, f"{len(mine)} rows, {spent:.1f}s" + (f" types {odd}" if odd else "")


def main() -> int:
    sf_dir, *names = sys.argv[1:]
    spark = get_session(
        "check", f"local[{os.environ.get('BENCH_CPUS', '8')}]", **{
            "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names or catalog.queries():
        try:
            good, note = compare(spark, con, sf_dir, name)
        except Exception as error:  # report and go on with the other queries
            good, note = False, f"{type(error).__name__}: {str(error)[:700]}"
        bad += not good
        print("ok  " if good else "FAIL", name, note, flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
