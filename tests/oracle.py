"""Compare registered queries with their SQL twins in DuckDB."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
         "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, dt.datetime | dt.date):
        return v.isoformat()
    return repr(v)


def spark_rows(df):
    names = sorted(df.columns)
    types = [TYPES.get(dict(df.dtypes)[n], dict(df.dtypes)[n]) for n in names]
    rows = sorted(tuple(_plain(v) for v in r) for r in df.select(*names).collect())
    return names, types, rows


def duck_rows(con, sql):
    cur = con.execute(sql)
    cols = [(d[0], str(d[1])) for d in cur.description]
    place = sorted(range(len(cols)), key=lambda i: cols[i][0])
    rows = sorted(tuple(_plain(r[i]) for i in place) for r in cur.fetchall())
    return [cols[i][0] for i in place], [cols[i][1] for i in place], rows


def compare(df, con, sql) -> str | None:
    """None when equal, else what differs."""
    a, b = spark_rows(df), duck_rows(con, sql)
    if a[0] != b[0]:
        return f"columns {a[0]} != {b[0]}"
    if len(a[2]) != len(b[2]):
        return f"rows {len(a[2])} != {len(b[2])}"
    if a[2] != b[2]:
        differ = [(x, y) for x, y in zip(a[2], b[2]) if x != y]
        return f"{len(differ)} of {len(a[2])} rows differ in {a[0]}, e.g. {differ[0]}"
    if a[1] != b[1]:
        return f"types {[(n, x, y) for n, x, y in zip(a[0], a[1], b[1]) if x != y]}"
    return None


def main() -> None:
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    folder, wanted = sys.argv[1], sys.argv[2:]
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "12g")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, twins, bad = connect(folder), oracle_sql(), 0
    for name, run in queries().items():
        if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            if name in twins:
                said = compare(df, con, twins[name])
                if said is None and not duck_rows(con, twins[name])[2]:
                    said = "EMPTY"
            else:
                rows = df.collect()
                said = None if rows else "no rows"
                print(f"   {name}: {len(rows)} rows, e.g. {rows[:3]}"[:600])
        except Exception as e:  # noqa: BLE001
            said = f"{type(e).__name__}: {str(e)[:700]}"
        bad += said is not None
        print(f"{'ok ' if said is None else 'BAD'} {name} {time.time() - start:.1f}s {said or ''}", flush=True)
    print(f"{bad} bad")


if __name__ == "__main__":
    main()
