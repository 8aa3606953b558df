"""Filling and defaulting nulls. Dropping is ``df.na.drop`` as Spark gives it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType, StringType

from peneira.functions.names import named, quoted


def fill(df: DataFrame, value: object, columns: list[str] | None = None) -> DataFrame:
    """Fill nulls with ``value``.

    Without ``columns`` every column of the value's kind is filled: text fills
    text columns only, a number numeric ones only. A *named* column of another
    kind is an error; Spark alone would leave it as it is.
    """
    kind = (
        StringType if isinstance(value, str) else BooleanType if isinstance(value, bool) else NumericType
    )
    wrong = [c for c in columns or [] if not isinstance(df.schema[c].dataType, kind)]
    if wrong:
        raise TypeError(f"{value!r} cannot fill {wrong}")
    return df.na.fill(value, subset=columns and [quoted(c) for c in columns])


def fill_then_cast(df: DataFrame, name: str, text: str = "0", kind: str = "int") -> DataFrame:
    """Fill a text column, then convert it: text that is no number ends as null."""
    return fill(df, text, [name]).withColumn(name, named(name).try_cast(kind))


def cast_then_fill(df: DataFrame, name: str, value: object = 0, kind: str = "int") -> DataFrame:
    """Convert a text column, then fill it: text that is no number ends as ``value``."""
    return fill(df.withColumn(name, named(name).try_cast(kind)), value, [name])


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """A default per column, in one projection; columns not named pass through.

    A default for a column that is not there is an error.
    """
    missing = [c for c in defaults if c not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}; there are {df.columns}")
    return df.select(
        *[
            F.coalesce(named(c), F.lit(defaults[c])).alias(c) if c in defaults else named(c)
            for c in df.columns
        ]
    )
