"""Tables, views and the bulk load."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from peneira.sources.delimited import read_csv
from peneira.sources.structured import inline_rows, read_json, read_parquet

CONCURRENT_LOADS = 4


def save_table(df: DataFrame, name: str, schema_location: str | None = None) -> DataFrame:
    """Replace the managed table ``schema.table`` and return a scan of it.

    The schema is made if it is missing, at ``schema_location`` if given, else
    in the session's warehouse. A table cannot replace itself while it is read:
    write to another name first.
    """
    schema, _, _ = name.rpartition(".")
    if schema:
        _make_schema(df.sparkSession, schema, schema_location)
    df.write.mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def _make_schema(spark: SparkSession, schema: str, location: str | None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}{place}")


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Make ``df`` known to SQL as ``name`` for this session."""
    df.createOrReplaceTempView(name)
    return df


@dataclass(frozen=True)
class TableSpec:
    """Where one entity's files are and how to read them."""

    path: str
    schema: str
    format: str = "csv"
    options: Mapping[str, object] = field(default_factory=dict)


def bulk_load(
    spark: SparkSession,
    specs: Mapping[str, TableSpec],
    schema: str,
    schema_location: str | None = None,
) -> DataFrame:
    """Load each entity's files into the table ``schema.<entity>``.

    CSV files go through ``read_csv``: a header that does not name the schema's columns in
    order is an error. The report has one row per table: ``table_name``, ``n_rows``,
    ``n_columns`` and ``n_rejected``, the rows of a CSV file with a field that is no value of its
    type or with too many or too few fields; what could be read of them is loaded. Rows are
    counted while they are written.
    """

    def load(entity: str) -> tuple[str, int, int, int]:
        rows, rejected = _read(spark, specs[entity])
        seen = Observation()
        bad = F.lit(0).cast("long") if rejected is None else F.count(F.col(rejected))
        counted = rows.observe(seen, F.count(F.lit(1)).alias("rows"), bad.alias("rejected"))
        loaded = counted if rejected is None else counted.drop(rejected)
        save_table(loaded, f"{schema}.{entity}")
        return entity, seen.get["rows"], len(loaded.columns), seen.get["rejected"]

    _make_schema(spark, schema, schema_location)
    # Small tables load while the last tasks of a large one still run.
    with ThreadPoolExecutor(CONCURRENT_LOADS) as pool:
        report = list(pool.map(load, specs))
    return inline_rows(spark, report, "table_name string, n_rows long, n_columns int, n_rejected long")


def _read(spark: SparkSession, spec: TableSpec) -> tuple[DataFrame, str | None]:
    """The entity's rows, and the column that holds the lines which do not fit, if the format has one."""
    if spec.format == "csv":
        options = dict(spec.options)
        header = str(options.pop("header", False)).lower() == "true"
        rejected = f"rejected_{uuid.uuid4().hex}"
        lines = f"{spec.schema}, {rejected} string"
        return read_csv(
            spark, spec.path, header=header, schema=lines, columnNameOfCorruptRecord=rejected, **options
        ), rejected
    if spec.format == "json":
        return read_json(spark, spec.path, spec.schema, **spec.options), None
    if spec.format == "parquet":
        return read_parquet(spark, spec.path, spec.schema), None
    return spark.read.format(spec.format).schema(spec.schema).options(**spec.options).load(spec.path), None
