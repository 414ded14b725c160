"""Runs registered queries against their DuckDB SQL and compares all values."""

from __future__ import annotations

import datetime as dt
import math
import time
from decimal import Decimal
from pathlib import Path

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if value is None or isinstance(value, (bool, str)):
        return value
    if isinstance(value, (int, float, Decimal)):
        number = float(value)
        return "nan" if math.isnan(number) else number
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return str(value)


def rows(columns: list[str], data) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(row[i]) for i in order) for row in data]
    return sorted(out, key=repr)


def difference(spark, folder: str, query, sql: str) -> tuple[str | None, int, float]:
    """What differs first (None if nothing), the row count, seconds in Spark."""
    start = time.time()
    df = query(spark, folder)
    got = rows(df.columns, df.collect())
    seconds = time.time() - start
    cursor = duck(folder).execute(sql)
    names = [d[0] for d in cursor.description]
    expected = rows(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}", len(got), seconds
    if len(got) != len(expected):
        return f"{len(got)} rows, expected {len(expected)}", len(got), seconds
    for a, b in zip(got, expected):
        if a != b:
            return f"{sorted(names)}: {a} != {b}", len(got), seconds
    return None, len(got), seconds
