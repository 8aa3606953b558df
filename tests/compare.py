"""Comparing a Spark result with its SQL twin, whatever the row order."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return db


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def as_bag(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    bag = Counter(tuple(_plain(row[i]) for i in order) for row in rows)
    return [columns[i] for i in order], bag


def spark_bag(df: DataFrame) -> tuple[list[str], Counter]:
    return as_bag(df.columns, df.collect())


def duck_bag(db: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    result = db.execute(sql)
    return as_bag([d[0] for d in result.description], result.fetchall())
