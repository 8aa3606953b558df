"""Describing a table, and comparing file formats."""

from __future__ import annotations

import functools
import operator
import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from peneira.functions.names import named
from peneira.sinks.files import write_csv, write_json, write_parquet
from peneira.sources.delimited import read_csv
from peneira.sources.structured import inline_rows, read_json, read_parquet
from peneira.workspace import drop_folder

ROWS_PER_FILE = 250_000  # at most, in the files that ``compare_formats`` writes


def table_profile(df: DataFrame, exact: bool = False) -> DataFrame:
    """Name, position, type, nulls and distinct values of each column, and the number of rows.

    Everything comes from one pass. Distinct values are estimated (about 5 %
    off). ``exact`` is for small tables: it makes a copy of every row for each column, and
    shuffles each column's distinct values.
    Null is not counted as a value.
    """
    distinct = F.count_distinct if exact else F.approx_count_distinct
    measures, described = [], []
    for position, field in enumerate(df.schema):
        column = F.col(f"`{field.name}`")
        measures += [
            F.count_if(column.isNull()).alias(f"nulls_{position}"),
            distinct(column).alias(f"distinct_{position}"),
        ]
        described.append(
            F.struct(
                F.lit(field.name).alias("column_name"),
                F.lit(position).alias("position"),
                F.lit(field.dataType.simpleString()).alias("data_type"),
                F.col(f"nulls_{position}").alias("n_nulls"),
                F.col(f"distinct_{position}").alias("n_distinct"),
                F.col("n_rows"),
            )
        )
    return df.agg(*measures, F.count("*").alias("n_rows")).select(F.inline(F.array(*described)))


def read_format(spark: SparkSession, path: str, name: str, schema: StructType) -> DataFrame:
    """The rows of files that ``compare_formats`` wrote."""
    if name == "csv":
        return read_csv(spark, path, header=True, schema=schema)
    return read_json(spark, path, schema) if name == "json" else read_parquet(spark, path, schema)


def _portions(copy: DataFrame, path: str, most: int) -> list[DataFrame]:
    """The rows of plain Parquet files as DataFrames of some whole files each, with ``most`` rows or a single file."""
    spark, schema = copy.sparkSession, copy.schema
    names = copy.select(copy.metadataColumn("_metadata")["file_name"].alias("name"))
    portions, size = [[]], 0
    for r in names.groupBy("name").count().orderBy("name").collect():  # a row for each file, from the footers
        if portions[-1] and size + r["count"] > most:
            portions.append([])
            size = 0
        portions[-1].append(f"{path}/{r.name}")
        size += r["count"]
    return [spark.read.schema(schema).load(files or path, format="parquet") for files in portions]


def compare_formats(
    df: DataFrame,
    folder: str,
    contents: Sequence[Column] = (),
    rows_per_file: int = ROWS_PER_FILE,
    *,
    by: Sequence[str] = (),
    rows_at_once: int | None = None,
) -> DataFrame:
    """Write ``df`` as Parquet, CSV and JSON, plain and gzip; measure each.

    The result has, per format, the files, their bytes and the seconds of a
    write and of a scan of all rows and columns. ``df`` is computed once, for
    the plain Parquet files; the others are written from those. With ``contents``,
    aggregates of the rows (of each value of the columns ``by``), the scan computes them on its way and leaves
    them in Parquet files, ``<folder>/contents-<format>-<compression>``, so that no file is read twice for them.

    No file has more than ``rows_per_file`` rows: a gzip text file is read by one task, and
    input in a few large pieces would else keep all the writes and scans to as few tasks.

    All files stay, some ten times the plain Parquet, unless ``rows_at_once`` is given. Then
    every other format is written, scanned and deleted in portions of so many rows (a file at least), and
    the plain Parquet files go at the end: no more than these and a portion are ever on disk. Files, bytes
    and seconds are sums over the portions, and ``contents`` are of each portion: they must be such as the caller
    can put together, sums for example.
    """
    spark, schema = df.sparkSession, df.schema
    write: dict[str, Callable] = {
        "parquet": write_parquet,
        "csv": functools.partial(write_csv, header=True),
        "json": write_json,
    }
    # The values of every column are counted, or the scan would leave out those that no aggregate needs.
    n_values = functools.reduce(operator.add, [F.count(named(c)) for c in df.columns], F.lit(0))
    portions, measured, plain = [df], [], None
    for name in write:
        for compression in (None, "gzip"):
            label = f"{name}-{compression or 'default'}"
            sums = [0, 0, 0.0, 0.0]
            for k, rows in enumerate(portions):
                path = f"{folder}/{label}" if rows_at_once is None else f"{folder}/{label}/{k}"
                started = time.perf_counter()
                write[name](rows, path, compression=compression, maxRecordsPerFile=rows_per_file)
                written = time.perf_counter()
                copy = read_format(spark, path, name, schema)
                if contents:
                    found = copy.groupBy(*map(named, by)).agg(*contents, n_values.alias("n_values"))
                    found.write.mode("append" if k else "overwrite").parquet(f"{folder}/contents-{label}")
                else:
                    copy.write.format("noop").mode("overwrite").save()
                scanned = time.perf_counter()
                files = spark.read.format("binaryFile").load(path)
                size = files.agg(F.count("*").alias("files"), F.sum("length").alias("bytes")).first()
                seen = (size["files"], size["bytes"] or 0, written - started, scanned - written)
                sums = [a + b for a, b in zip(sums, seen, strict=True)]
                if plain and rows_at_once is not None:
                    drop_folder(spark, path)
            measured.append((name, compression or "default", sums[0], sums[1] if sums[0] else None, *sums[2:]))
            if not plain:
                plain = f"{folder}/{label}"
                portions = [copy] if rows_at_once is None else _portions(copy, path, rows_at_once)
            elif rows_at_once is not None:
                drop_folder(spark, f"{folder}/{label}")
    if rows_at_once is not None:
        drop_folder(spark, plain)
    return inline_rows(
        spark,
        measured,
        "format string, compression string, n_files long, n_bytes long, "
        "write_seconds double, scan_seconds double",
    )
