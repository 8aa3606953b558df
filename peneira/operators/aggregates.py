"""Aggregates per key, counts, sorts and previews.

All of them pre-aggregate in the scanning tasks, so what is shuffled grows with
the number of keys, not of rows, and one frequent key is no burden.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sum_per_key(df: DataFrame, key: str, value: Column | str, name: str = "total") -> DataFrame:
    return df.groupBy(key).agg(F.sum(value).alias(name))


def count_per_key(df: DataFrame, key: str, name: str = "n_rows") -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias(name))


def summary_per_key(
    df: DataFrame,
    key: str,
    value: Column | str,
    where: Column | None = None,
    count_name: str = "n_rows",
    sum_name: str = "total",
) -> DataFrame:
    """Count and sum per key in one scan and one shuffle.

    It gives what co-grouping a count per key with a sum per key gives.
    """
    rows = df if where is None else df.filter(where)
    return rows.groupBy(key).agg(F.count("*").alias(count_name), F.sum(value).alias(sum_name))


def ranked_counts(df: DataFrame, key: str, counted: str, name: str = "n") -> DataFrame:
    """Non-null values of ``counted`` per key, most first; the key breaks ties."""
    return df.groupBy(key).agg(F.count(counted).alias(name)).orderBy(F.desc(name), key)


def row_count(df: DataFrame, name: str = "n_rows") -> DataFrame:
    """One row, one number. Over Parquet no column is read."""
    return df.agg(F.count("*").alias(name))


def count_where(df: DataFrame, **conditions: Column) -> DataFrame:
    """How many rows meet each condition, all in one pass."""
    return df.agg(*[F.count_if(condition).alias(name) for name, condition in conditions.items()])


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls of each column in one pass: ``column_name``, ``n_nulls``."""
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("n_nulls")) for c in df.columns]
    return counts.select(F.inline(F.array(*pairs)))


def first_rows(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """The first ``n`` rows in the given order: a preview that repeats.

    Each task keeps its own first ``n``; there is no full sort.
    """
    return df.orderBy(*order).limit(n)
