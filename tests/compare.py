"""Runs named queries and their DuckDB statements over the same tables and compares every value."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    """Comparable form: kind and value, floats to nine significant digits."""
    if value is None:
        return ("null", "")
    if isinstance(value, bool):
        return ("bool", str(value))
    if isinstance(value, int):
        return ("int", str(value))
    if isinstance(value, float):
        return ("float", "nan" if math.isnan(value) else f"{value + 0.0:.9g}")
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, (datetime.date, datetime.datetime)):
        return ("date", value.isoformat())
    return ("text", str(value))


def spark_rows(df) -> tuple[list[str], list]:
    columns = sorted(df.columns)
    return columns, sorted(tuple(_cell(row[c]) for c in columns) for row in df.collect())


def duck_rows(con, sql: str) -> tuple[list[str], list]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    columns = sorted(names)
    at = [names.index(c) for c in columns]
    return columns, sorted(tuple(_cell(row[i]) for i in at) for row in result.fetchall())


def difference(df, con, sql: str) -> str | None:
    """None if equal, else what differs first."""
    columns, rows = spark_rows(df)
    other_columns, others = duck_rows(con, sql)
    if columns != other_columns:
        return f"columns {set(columns) ^ set(other_columns)}"
    if len(rows) != len(others):
        return f"rows {len(rows)} != {len(others)}"
    for mine, theirs in zip(rows, others):
        if mine != theirs:
            return str([(c, a, b) for c, a, b in zip(columns, mine, theirs) if a != b][:6]) + f" in {mine[:4]}"
    return None
