"""Compare a Spark result with DuckDB on the same tables."""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, decimal.Decimal, float)):
        return round(float(value), 6)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat(sep=" ")
    return str(value) if isinstance(value, dt.date) else value


def rows(columns, records) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(record[i]) for i in order) for record in records)


def compare(df, db, sql: str) -> tuple[bool, str]:
    result = db.execute(sql)
    columns = [c[0] for c in result.description]
    expected = rows(columns, result.fetchall())
    found = rows(df.columns, df.collect())
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(columns)}"
    if expected != found:
        extra, missing = list((found - expected).items())[:2], list((expected - found).items())[:2]
        return False, f"{sum(found.values())} rows != {sum(expected.values())}; extra {extra}; missing {missing}"
    return True, f"{sum(found.values())} rows"
