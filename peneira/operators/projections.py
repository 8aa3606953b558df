"""Choosing, naming and converting columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peneira.functions.names import named
from peneira.functions.text import split_on


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename columns; a name the DataFrame lacks is an error.

    Spark's own rename passes over missing names without a word.
    """
    missing = [old for old in names if old not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}; there are {df.columns}")
    return df.withColumnsRenamed(dict(names))


def key_value(df: DataFrame, key: Column | str, value: Column | str) -> DataFrame:
    """Two columns, ``key`` and ``value``, for the keyed aggregates."""
    column = lambda c: F.col(c) if isinstance(c, str) else c
    return df.select(column(key).alias("key"), column(value).alias("value"))


def explode_tokens(df: DataFrame, text: str, name: str = "token") -> DataFrame:
    """One row per blank-separated word of each line of ``text``.

    Empty words, from blanks that follow each other or stand at an end, are
    kept. Other columns are not carried along, so the scan reads only ``text``.
    """
    lines = df.select(F.explode(split_on(text, "\n")).alias("line"))
    return lines.select(F.explode(split_on("line", " ")).alias(name))


def at(df: DataFrame, position: int) -> Column:
    """The column at a position, 0-based, resolved to its name at once."""
    return named(df.columns[position])


def cast_with_rejects(df: DataFrame, name: str, kind: str = "int") -> tuple[DataFrame, DataFrame]:
    """Convert a text column; return ``(converted, rejects)``.

    ``converted`` has every row, with null where the text is no value of that
    type. ``rejects`` has the rows whose text was lost that way, as it was. A
    plain cast would fail the whole job at the first bad text. Using both reads ``df``
    twice; ``with_cast`` gives the conversion and the lost text in one.
    """
    parsed = named(name).try_cast(kind)
    return df.withColumn(name, parsed), df.filter(named(name).isNotNull() & parsed.isNull())


def with_cast(df: DataFrame, name: str, kind: str = "int", rejected: str = "rejected") -> DataFrame:
    """Convert a text column in place; ``rejected`` has the text where it is no value of that type, else null."""
    if rejected in df.columns:
        raise ValueError(f"there is a column {rejected} already")
    parsed = named(name).try_cast(kind)
    lost = F.when(parsed.isNull(), named(name)).alias(rejected)
    return df.select(*(parsed.alias(c) if c == name else named(c) for c in df.columns), lost)
