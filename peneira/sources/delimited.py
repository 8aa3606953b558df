"""Delimited text."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from peneira.functions.names import named
from peneira.functions.text import split_on
from peneira.sources.lines import cut_return, plain_line, without_first_lines

# A doubled quote inside a quoted field stands for one quote.
QUOTING = {"quote": '"', "escape": '"'}


# Stands for null in files, so that empty text stays text. A text that looks like the mark,
# after any number of backslashes, is written with one backslash more.
NULL_MARK = "\\N"
LOOKS_LIKE_NULL = r"^\\+N$"
OWN_MARKS = "_text_like_null_has_a_backslash"  # a file that ``write_csv`` puts beside those it wrote


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    *,
    header: bool,
    schema: StructType | str | None = None,
    sep: str = ",",
    own_marks: bool | None = None,
    **options: object,
) -> DataFrame:
    """Delimited files or folders of part files.

    ``header`` has no default: taking the first line for a header, or not, by
    guess loses or invents a row. The header is dropped once per file. Without
    ``schema`` Spark reads the data once more to infer the types, and names the
    columns ``_c0``, ``_c1``, … if there is no header. With both, a header that
    does not name the schema's columns in order is an error. Compressed files
    are recognised by their ending.

    An empty field and ``\\N`` are null, a quoted empty field is empty text; ``nullValue`` sets another text for
    null. What ``write_csv`` wrote comes back as it was: its folders are known by a file in them, and the
    backslash it put before a text like ``\\N`` is taken off. Files from elsewhere keep such texts as
    they are. ``own_marks`` says which of the two holds, for files that were moved or for paths of both kinds.
    Text with line breaks inside quotes needs ``multiLine=True``, which makes
    each file one task, and ``lineSep="\\n"`` if its carriage returns are to stay.
    """
    settings = {**QUOTING, "nullValue": NULL_MARK, **options}
    reader = spark.read.options(header=header, sep=sep, **settings)
    if schema is None:
        rows = reader.option("inferSchema", True).csv(path)
    else:
        rows = reader.schema(schema).option("enforceSchema", not header).csv(path)
    if own_marks is None:
        own_marks = "nullValue" not in options and _written_here(spark, [path] if isinstance(path, str) else path)
    return _without_marks(rows) if own_marks else rows


def _written_here(spark: SparkSession, paths: list[str]) -> bool:
    """Whether ``write_csv`` wrote these folders, or the folders these files are in."""
    found = set()
    for path in map(spark._jvm.org.apache.hadoop.fs.Path, paths):
        system = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        for status in system.globStatus(path) or []:
            folder = status.getPath() if status.isDirectory() else status.getPath().getParent()
            found.add(bool(system.exists(spark._jvm.org.apache.hadoop.fs.Path(folder, OWN_MARKS))))
    if len(found) > 1:
        raise ValueError("some of the folders were written by write_csv and some not: set own_marks, or read them apart")
    return found == {True}


def _without_marks(rows: DataFrame) -> DataFrame:
    """Takes the added backslash off texts that look like the null mark."""

    def text(name: str) -> Column:
        own = named(name)
        marked = own.startswith("\\\\") & own.rlike(LOOKS_LIKE_NULL)
        return F.when(marked, F.substring(own, F.lit(2), F.length(own))).otherwise(own).alias(name)

    return rows.select(*(text(f.name) if isinstance(f.dataType, StringType) else named(f.name) for f in rows.schema))


def with_marks(rows: DataFrame) -> DataFrame:
    """Adds a backslash to texts that look like the null mark."""

    def text(name: str) -> Column:
        own = named(name)
        like = own.startswith("\\") & own.rlike(LOOKS_LIKE_NULL)
        return F.when(like, F.concat(F.lit("\\"), own)).otherwise(own).alias(name)

    return rows.select(*(text(f.name) if isinstance(f.dataType, StringType) else named(f.name) for f in rows.schema))


# In the order in which they are tried for text whose type is to be inferred.
INFERRED = ("int", "bigint", "double", "date", "timestamp", "boolean")


def infer_types(rows: DataFrame) -> DataFrame:
    """The text columns converted to the first type of ``INFERRED`` that all their texts are values of."""
    fits = [
        F.count_if(named(c).isNotNull() & named(c).try_cast(kind).isNull()).alias(f"{i}_{kind}")
        for i, c in enumerate(rows.columns)
        for kind in INFERRED
    ]
    some = [F.count(named(c)).alias(f"{i}_n") for i, c in enumerate(rows.columns)]
    seen = rows.agg(*fits, *some).first()  # one row

    def kind_of(i: int) -> str:
        return next((k for k in INFERRED if seen[f"{i}_n"] and not seen[f"{i}_{k}"]), "string")

    return rows.select(*(named(c).try_cast(kind_of(i)).alias(c) for i, c in enumerate(rows.columns)))


def read_csv_with_preamble(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str | None = None,
    *,
    preamble: int,
    header: bool = True,
    sep: str = ",",
    **options: object,
) -> DataFrame:
    """Delimited files with ``preamble`` lines above the header of each file.

    With ``header``, every file's header line must name the schema's columns in order, quoted or not. Without
    ``schema`` the names come from the header line of the first file, which all must share,
    and the types are inferred in one more pass. Quoted line breaks are not supported. A
    line that does not fit the schema gives nulls in the fields that do not.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    settings = {key: str(value) for key, value in {"sep": sep, **QUOTING, "nullValue": NULL_MARK, **options}.items()}
    # As in read_csv, case counts in names only if the session says so.
    names_of = functools.partial(header_names, sep=settings["sep"], quote=settings["quote"])
    check = None
    if schema is None:
        if not header:
            raise ValueError("without a header, give a schema")
        first = sorted(lines.inputFiles())[0]
        head = spark.read.option("lineSep", "\n").text(first).take(preamble + 1)
        kind = StructType([StructField(name, StringType()) for name in names_of(plain_line(head[-1].value))])
    else:
        kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if header:
        fold = str if spark.conf.get("spark.sql.caseSensitive") == "true" else str.lower
        check = functools.partial(_check_header, wanted=kind.names, names_of=names_of, fold=fold)
    body = without_first_lines(lines, preamble + int(header), check)
    record = F.from_csv(cut_return(F.col("value")), kind.toDDL(), settings)
    rows = body.filter(F.trim(F.regexp_replace("value", "\r$", "")) != "").select(record.alias("record")).select("record.*")
    return infer_types(rows) if schema is None else rows


def header_names(line: str, sep: str, quote: str) -> list[str]:
    """The fields of a header line, read as CSV: within quotes a separator is text and two quotes are one."""
    names, rest = [], line
    while True:
        name, start = "", rest.lstrip(" ")
        if quote and start.startswith(quote):
            inner = start[len(quote) :]
            while True:
                part, closed, inner = inner.partition(quote)
                name += part
                if not closed or not inner.startswith(quote):
                    break
                name, inner = name + quote, inner[len(quote) :]
            tail, found, rest = inner.partition(sep)
            name += tail.rstrip(" ")
        else:
            name, found, rest = rest.partition(sep)
        names.append(name)
        if not found:
            return names


def _check_header(path: str, line: str, wanted: list[str], names_of: Callable, fold: Callable) -> None:
    names = names_of(line)
    if list(map(fold, names)) != list(map(fold, wanted)):
        raise ValueError(f"the header of {path} names {names} and not {wanted}")


def split_fields(line: Column | str, sep: str, names: list[str]) -> list[Column]:
    """Positional text fields of a line; a position the line lacks is null."""
    parts = split_on(line, sep)
    return [F.get(parts, i).alias(name) for i, name in enumerate(names)]
