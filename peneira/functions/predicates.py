"""Row conditions as Columns, to be used in ``filter`` and combined freely."""

from __future__ import annotations

import functools
import operator
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    FractionalType,
    NumericType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

from peneira.functions.names import named
from peneira.functions.text import standardise
from peneira.workspace import new_folder

def all_of(*conditions: Column) -> Column:
    return functools.reduce(operator.and_, conditions)


def any_of(*conditions: Column) -> Column:
    return functools.reduce(operator.or_, conditions)


def differs(name: str, value: object, keep_null: bool = False) -> Column:
    """Not equal. As in SQL a null row drops out, unless ``keep_null``."""
    return ~named(name).eqNullSafe(F.lit(value)) if keep_null else named(name) != value


def half_open(name: str, low: object, high: object) -> Column:
    """``low <= name < high``"""
    return (named(name) >= low) & (named(name) < high)


def closed(name: str, low: object, high: object) -> Column:
    """``low <= name <= high``"""
    return named(name).between(low, high)


def equals_ignoring_case(name: str, value: str) -> Column:
    return F.lower(named(name)) == value.lower()


def equals_trimmed(name: str, value: str, side: str = "both") -> Column:
    """Equal when blanks at the ``left``, ``right`` or ``both`` ends do not count."""
    trim = {"both": F.trim, "left": F.ltrim, "right": F.rtrim}[side]
    return trim(named(name)) == value


def equals_standardised(name: str, value: str) -> Column:
    """Equal when case, accents and outer blanks do not count, on either side.

    A condition on a computed value is not pushed into the scan; for repeated
    use store the standardised column once and filter on that.
    """
    return standardise(named(name)) == standardise(F.lit(value))


SHORT_LIST = 100  # values that also become an ``isin``


def keep_listed(df: DataFrame, name: str, values: Sequence | DataFrame) -> DataFrame:
    """Rows whose ``name`` is in the list: a Python list, or a DataFrame of one column.

    The values are converted to the column's type first; one that this type cannot hold
    as it is, such as 1.5 for whole numbers, matches nothing, and neither does null. Values of a
    Python list may be of several types, and are converted one type after the other.

    The list becomes a semi join, whose strategy Spark picks by the list's size; of any
    length it behaves alike. Before the join stands a condition that reaches the scan, so that
    files and row groups without a listed value are not read: from the smallest to the largest value,
    and ``isin`` for up to ``SHORT_LIST`` of them. It is learned when this is called, from an aggregate of the
    list, and leaves out no row that the join would keep. A Python list is held in the driver's memory, so
    give long ones as a DataFrame; its distinct values are stored in the shared folder first.
    """
    kind = df.schema[name].dataType
    listed = f"listed_{uuid.uuid4().hex}"  # no column of the rows has this name
    if isinstance(values, DataFrame):
        fits = _stored(_fitting(values, kind, listed).distinct())
    else:
        by_type: dict[type, dict] = {}
        for value in values:
            if value is not None:
                by_type.setdefault(type(value), {})[value] = None
        if not by_type:
            return df.filter(F.lit(False))
        tables = [pa.table({"value": pa.array(list(same))}) for same in by_type.values()]
        fits = functools.reduce(
            DataFrame.union, [_fitting(df.sparkSession.createDataFrame(t), kind, listed) for t in tables]
        )
    near = _near_condition(named(name), kind, fits, listed)
    rows = df if near is None else df.filter(near)
    return rows.join(fits, named(name) == F.col(listed), "left_semi")


def _fitting(values: DataFrame, kind: DataType, listed: str) -> DataFrame:
    """The values that the column's type holds as they are, as that type."""
    given = named(values.columns[0])
    same = given.try_cast(kind.simpleString())
    own = values.schema[0].dataType.simpleString()
    return values.filter(same.try_cast(own) == given).select(same.alias(listed))


def _stored(values: DataFrame) -> DataFrame:
    folder = new_folder(values.sparkSession, "listed")
    values.write.parquet(folder)
    return values.sparkSession.read.schema(values.schema).parquet(folder)


def _near_condition(own: Column, kind: DataType, fits: DataFrame, listed: str) -> Column | None:
    """A condition on the column that all listed values meet and a scan can use; None for types that scans do not order."""
    value, text = F.col(listed), kind == StringType()
    fractional = isinstance(kind, FractionalType) and not isinstance(kind, DecimalType)
    if not (text or isinstance(kind, (NumericType, DateType, TimestampType, TimestampNTZType))):
        return None
    # Times travel as microseconds: a Python datetime would be read in another time zone.
    is_time = isinstance(kind, (TimestampType, TimestampNTZType))
    plain = F.unix_micros(value.cast("timestamp")) if is_time else value
    strange = F.bool_or(F.isnan(value)) if fractional else F.lit(False)
    seen = fits.agg(F.min(plain).alias("low"), F.max(plain).alias("high"), F.count_distinct(value).alias("n"), strange.alias("nan")).first()
    if not seen.n:
        return F.lit(False)
    if seen.nan:  # larger than all numbers in Spark, but not in every file's statistics
        return None

    def literal(x: object) -> Column:
        return (F.timestamp_micros(F.lit(x)) if is_time else F.lit(x)).cast(kind)

    low, high = seen.low, seen.high
    if fractional:  # the two zeros are equal, but not to a file's statistics
        low, high = (-0.0 if low == 0 else low), (0.0 if high == 0 else high)
    near = (own >= literal(low)) & (own <= literal(high))
    if seen.n <= SHORT_LIST and not fractional:
        near = near & own.isin([literal(r[0]) for r in fits.select(plain).distinct().collect()])
    return near
