"""Row-by-row comparison of Spark results with DuckDB over the same parquet files."""

import math
from decimal import Decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


def spark_rows(df):
    return sorted_rows(df.columns, df.collect())


def duck_rows(con, sql):
    result = con.execute(sql)
    return sorted_rows([d[0] for d in result.description], result.fetchall())
