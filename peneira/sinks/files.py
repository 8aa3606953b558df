"""File writers. All of them replace what the folder held before."""

from __future__ import annotations

import functools
import math
import operator
import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType, VariantType

from peneira.functions.names import named
from peneira.sources.delimited import NULL_MARK, OWN_MARKS, QUOTING, with_marks
from peneira.workspace import new_folder

# Spark writes milliseconds to CSV and JSON unless told otherwise.
MICROSECONDS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
# And cuts the blanks off the ends of text in CSV.
KEEP_BLANKS = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_text(
    df: DataFrame, path: str, sep: str = ",", compression: str | None = None, *, strict: bool = True
) -> None:
    """One line per row: the columns as text, joined by ``sep``; null is empty.

    A value with a line break, or with the separator if there are several columns, would be
    read as other rows or fields: it is an error, unless ``strict`` is off.
    """
    fields = [F.coalesce(named(name).cast("string"), F.lit("")) for name in df.columns]
    if strict:
        fields = [_unbroken(field, name, sep if len(fields) > 1 else "") for field, name in zip(fields, df.columns)]
    writer = df.select(F.concat_ws(sep, *fields).alias("value")).write.mode("overwrite")
    (writer if compression is None else writer.option("compression", compression)).text(path)


def _unbroken(field: Column, name: str, sep: str) -> Column:
    bad = field.contains("\n") | field.contains("\r")
    bad = bad | field.contains(sep) if sep else bad
    return F.when(bad, F.raise_error(F.lit(f"write_text: a line break or separator in {name}"))).otherwise(field)


def write_csv(
    df: DataFrame,
    path: str,
    *,
    header: bool = False,
    sep: str = ",",
    compression: str | None = None,
    **options: object,
) -> None:
    """Delimited files. Null is written as ``\\N`` and empty text as ``""``, so that ``read_csv`` tells them apart.

    A text that looks like the mark gets a backslash, which ``read_csv`` takes off again: it knows these
    files by an empty one named ``OWN_MARKS`` beside them. With ``nullValue`` another text stands for null, and no
    text is changed.
    """
    rows = df if "nullValue" in options else with_marks(df)
    settings = {**MICROSECONDS, **KEEP_BLANKS, **QUOTING, "nullValue": NULL_MARK, **options}
    writer = rows.write.mode("overwrite").options(header=header, sep=sep, **settings)
    (writer if compression is None else writer.option("compression", compression)).csv(path)
    if "nullValue" not in options:
        place = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path, OWN_MARKS)
        place.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).create(place, True).close()


def write_json(df: DataFrame, path: str, compression: str | None = None, **options: object) -> None:
    """JSON lines. Null fields are left out, so read back with a schema."""
    writer = df.write.mode("overwrite").options(**{**MICROSECONDS, **options})
    (writer if compression is None else writer.option("compression", compression)).json(path)


def write_parquet(df: DataFrame, path: str, compression: str | None = None, **options: object) -> None:
    writer = df.write.mode("overwrite").options(**options)
    (writer if compression is None else writer.option("compression", compression)).parquet(path)


def write_partitioned(
    df: DataFrame,
    path: str,
    by: list[str],
    compression: str | None = None,
    *,
    gather: bool = True,
    task_bytes: int | None = None,
) -> None:
    """Parquet in one folder per value of the columns ``by``.

    ``gather`` first brings rows of a folder together, or every task would
    write a small file into every folder. The bytes of each value are counted before (``df`` is computed
    twice; store it if it is dear). Values of up to ``task_bytes`` share tasks, whole; a larger one gets as many
    tasks of its own as that goes into it, and its rows are dealt among them by a hash of what they hold, so that a
    value with a third of all rows does not fall to a single writer, even if it comes from one file. Rows are placed by
    content and the task they come from: a task that runs again gives the same rows. ``task_bytes`` is
    the session's ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` unless given, or more if there would be
    over ``MOST_WRITERS`` tasks; adaptive execution plays no part. Without
    ``gather`` there is no shuffle; that suits input already grouped by folder,
    or a handful of folders.
    """
    if task_bytes is None:
        spark = df.sparkSession
        advised = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        task_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(advised)
    writer = (_dealt(df, by, task_bytes) if gather else df).write.mode("overwrite").partitionBy(*by)
    (writer if compression is None else writer.option("compression", compression)).parquet(path)


NESTED = (ArrayType, MapType, StructType, VariantType)
MOST_WRITERS = 50_000  # tasks of one write; so many values at most have writers of their own


def _row_bytes(df: DataFrame, by: list[str]) -> Column:
    """About how many bytes a row adds to a file: the lengths of its texts and the fixed sizes of the rest."""
    sizes = [F.lit(0)]
    for field in df.schema:
        kind = field.dataType
        if field.name in by:  # the folder's name has it
            continue
        if isinstance(kind, (StringType, BinaryType)):
            sizes.append(F.coalesce(F.octet_length(named(field.name)), F.lit(0)) + 4)
        elif isinstance(kind, NESTED):
            sizes.append(F.coalesce(F.octet_length(F.to_json(F.struct(named(field.name)))), F.lit(0)))
        else:
            sizes.append(F.lit(8))
    return functools.reduce(operator.add, sizes)


def value_bytes(df: DataFrame, by: list[str]) -> DataFrame:
    """About how many ``bytes`` the rows of each value of ``by`` take; stored."""
    keys = [named(name).alias(f"by_{i}") for i, name in enumerate(by)]
    rows = df.select(*keys, _row_bytes(df, by).cast("long").alias("bytes"))
    sizes = rows.groupBy(*rows.columns[:-1]).agg(F.sum("bytes").alias("bytes"))
    folder = new_folder(df.sparkSession, "value-bytes")
    sizes.write.parquet(folder)
    return df.sparkSession.read.schema(sizes.schema).parquet(folder)


def large_values(sizes: DataFrame, task_bytes: int) -> DataFrame:
    """The values with more than ``task_bytes``, how many ``writers`` each has and the number of the ``first``."""
    keys = sizes.columns[:-1]
    large = sizes.filter(F.col("bytes") > task_bytes).withColumn("writers", F.ceil(F.col("bytes") / task_bytes))
    before = Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    return large.withColumn("first", F.coalesce(F.sum("writers").over(before), F.lit(0)))


def _dealt(df: DataFrame, by: list[str], task_bytes: int) -> DataFrame:
    """The rows of each value of ``by`` in one task, those of a large one dealt among its own tasks."""
    sizes = value_bytes(df, by)
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    task_bytes = max(task_bytes, total // MOST_WRITERS)
    large = large_values(sizes, task_bytes)
    own = large.agg(F.coalesce(F.sum("writers"), F.lit(0)).alias("writers"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    shared = max(1, math.ceil((total - own.bytes) / task_bytes))
    task = F.pmod(F.xxhash64(*map(named, by)), F.lit(shared)) + own.writers
    mark, rows = uuid.uuid4().hex, df
    if own.writers:
        names = [f"{name}_{mark}" for name in large.columns]
        same = (named(a).eqNullSafe(F.col(b)) for a, b in zip(by, names, strict=False))
        rows = df.join(F.broadcast(large.toDF(*names)), functools.reduce(operator.and_, same), "left")  # at most MOST_WRITERS
        writers, first = F.col(f"writers_{mark}"), F.col(f"first_{mark}")
        content = [F.to_json(F.struct(named(f.name))) if isinstance(f.dataType, NESTED) else named(f.name) for f in df.schema]
        piece = first + F.pmod(F.xxhash64(*content, F.spark_partition_id()), writers)
        task = F.coalesce(piece, task)
    placed = rows.select(*map(named, df.columns), task.cast("int").alias(mark))
    return placed.repartitionById(shared + own.writers, F.col(mark)).drop(mark)
