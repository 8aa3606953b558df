"""JSON, Parquet, partitioned folders and rows given inline."""

from __future__ import annotations

import functools
import operator
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from peneira.functions.names import named

def inline_rows(spark: SparkSession, rows: Sequence[tuple], schema: StructType | str) -> DataFrame:
    """Rows written in the program, such as a lookup list. Not for data sets.

    They become part of the plan, so Spark knows their size when it joins them, and
    are held in the driver's memory: long lists belong in a file.
    """
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = zip(*rows) if rows else ([] for _ in fields)
    arrow = to_arrow_schema(fields)
    arrays = [pa.array(list(values), type=kind) for values, kind in zip(columns, arrow.types)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), fields)


def read_json(
    spark: SparkSession, path: str | list[str], schema: StructType | str | None = None, **options: object
) -> DataFrame:
    """JSON lines (``multiLine=True`` for a file that is one array).

    Without ``schema`` Spark reads the data once more to infer it, and orders
    the columns by name.
    """
    reader = spark.read.options(**options)
    return (reader if schema is None else reader.schema(schema)).json(path)


def read_parquet(
    spark: SparkSession, path: str | list[str], schema: StructType | str | None = None
) -> DataFrame:
    """Parquet files or folders; partition columns of a folder tree come back.

    Give ``schema`` for a partitioned folder, or values such as ``01`` are
    taken for numbers.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_partition(
    spark: SparkSession,
    root: str,
    values: Mapping[str, object],
    schema: StructType | str | None = None,
) -> DataFrame:
    """The rows of one partition, by one or more partition columns.

    ``values`` in the order of the folders, from the root: only the folder they lead to is
    listed and read, and the columns stay in the result. If there is no such folder, since
    the order is another or the first columns are missing, the whole tree is listed and
    filtered, with the same rows as result.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    folder = "/".join([root.rstrip("/"), *(f"{c}={_folder_value(value)}" for c, value in values.items())])
    try:
        rows = reader.option("basePath", root).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = reader.parquet(root)
    wanted = (named(c).isNull() if value is None else named(c) == value for c, value in values.items())
    return rows.filter(functools.reduce(operator.and_, wanted))


def _folder_value(value: object) -> str:
    """A partition value as Spark writes it in a folder's name."""
    if value is None:
        return "__HIVE_DEFAULT_PARTITION__"
    text = str(value).lower() if isinstance(value, bool) else str(value)
    special = '"#%\'*/:=?\\\x7f{[]^'
    return "".join(f"%{ord(c):02X}" if c in special or ord(c) < 32 else c for c in text)


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Even out partitions, e.g. after reading a few large gzip text files.

    A gzip text file cannot be split and is read by one task. Spark sizes the
    new partitions while running; ``columns`` brings equal values together as
    far as the size of a partition allows.
    """
    return df.hint("rebalance", *columns)
