"""Comparison of a Spark result with DuckDB on the same tables."""

import math
from decimal import Decimal
from pathlib import Path

import duckdb

DATA = Path("/root/testdata")


def connect(folder):
    con = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def plain(value):
    """One form for values both engines hold: exact numbers by value, doubles to 12 digits."""
    if isinstance(value, bool) or value is None:
        return repr(value)
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.12g}"
    if isinstance(value, int):
        return f"{float(value):.12g}" if abs(value) < 2**53 else str(value)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def spark_rows(df):
    return sorted(df.columns), rows_of(df.columns, df.collect())


def duckdb_rows(con, sql):
    result = con.sql(sql)
    return sorted(result.columns), rows_of(result.columns, result.fetchall())
