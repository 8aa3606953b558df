"""Every sink, read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peneira.plans.inputs import table
from peneira.plans.registry import query
from peneira.sinks import (
    TableSpec,
    bulk_load,
    register_view,
    save_table,
    write_csv,
    write_json,
    write_parquet,
    write_partitioned,
    write_text,
)
from peneira.sources import read_csv, read_json, read_lines, read_parquet
from peneira.workspace import new_folder, shared_root

STAR_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def new_schema(spark: SparkSession) -> tuple[str, str]:
    """This application's schema, and its place on shared storage."""
    app = spark.conf.get("spark.app.id", "app")
    schema = "peneira_" + "".join(c if c.isalnum() else "_" for c in app).lower()
    return schema, f"{shared_root(spark)}/peneira/{app}/tables"


def new_table(spark: SparkSession, name: str) -> tuple[str, str]:
    schema, location = new_schema(spark)
    return f"{schema}.{name}_{uuid.uuid4().hex[:12]}", location


@query(
    "K01",
    """SELECT CAST(o_orderkey AS VARCHAR) || '|' || o_orderstatus || '|' || o_orderpriority AS value
FROM orders""",
)
def snk_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "text")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    write_text(orders, path, sep="|")
    return read_lines(spark, path)


@query("K02", "SELECT * FROM supplier")
def snk_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier")
    path = new_folder(spark, "csv")
    write_csv(suppliers, path, sep=",")
    return read_csv(spark, path, header=False, schema=suppliers.schema)


ROUND_TRIP = """SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN chr(92) || 'N'
  WHEN 3 THEN '  ' || o_orderpriority || ' ' WHEN 4 THEN 'a "quote", a ; and a \\' WHEN 5 THEN 'two' || chr(10) || 'lines'
  ELSE chr(92) || chr(92) || 'N' END AS remark FROM orders"""


@query("K02", ROUND_TRIP)
def snk_csv_any_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null, empty text, the null mark itself, blanks, quotes and line breaks come back as they were."""
    orders = table(spark, sf_dir, "orders")
    rest = F.col("o_orderkey") % 7
    remark = (
        F.when(rest == 0, F.lit(None).cast("string"))
        .when(rest == 1, "")
        .when(rest == 2, "\\N")
        .when(rest == 3, F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit(" ")))
        .when(rest == 4, 'a "quote", a ; and a \\')
        .when(rest == 5, "two\nlines")
        .otherwise("\\\\N")
    )
    rows = orders.select("o_orderkey", remark.alias("remark"))
    path = new_folder(spark, "csv-any-text")
    write_csv(rows, path, header=True)
    return read_csv(spark, path, header=True, schema=rows.schema, multiLine=True, lineSep="\n")


@query("K03", "SELECT * FROM part")
def snk_csv_gzip(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    path = new_folder(spark, "csv-gzip")
    write_csv(parts, path, header=True, sep=";", compression="gzip")
    return read_csv(spark, path, header=True, sep=";", schema=parts.schema)


@query("K04", "SELECT * FROM customer")
def snk_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    path = new_folder(spark, "json")
    write_json(customers, path)
    return read_json(spark, path, customers.schema)


@query("K05", "SELECT * FROM customer")
def snk_json_gzip(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    path = new_folder(spark, "json-gzip")
    write_json(customers, path, compression="gzip")
    return read_json(spark, path, customers.schema)


@query("K06", "SELECT * FROM events")
def snk_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "parquet")
    write_parquet(table(spark, sf_dir, "events"), path)
    return read_parquet(spark, path)


@query("K07", "SELECT * FROM events")
def snk_parquet_gzip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "parquet-gzip")
    write_parquet(table(spark, sf_dir, "events"), path, compression="gzip")
    return read_parquet(spark, path)


@query(
    "K08",
    """SELECT o_orderstatus, count(*) AS n_rows, round(sum(o_totalprice), 2) AS total
FROM orders GROUP BY o_orderstatus""",
)
def snk_partition_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    path = new_folder(spark, "partition-one")
    write_partitioned(orders, path, ["o_orderstatus"])
    return (
        read_parquet(spark, path, orders.schema)
        .groupBy("o_orderstatus")
        .agg(F.count("*").alias("n_rows"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    )


@query(
    "K09",
    """SELECT l_returnflag, l_linestatus, count(*) AS n_rows, sum(l_quantity) AS quantity
FROM lineitem GROUP BY l_returnflag, l_linestatus""",
)
def snk_partition_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    path = new_folder(spark, "partition-two")
    write_partitioned(lines, path, ["l_returnflag", "l_linestatus"])
    return (
        read_parquet(spark, path, lines.schema)
        .groupBy("l_returnflag", "l_linestatus")
        .agg(F.count("*").alias("n_rows"), F.sum("l_quantity").alias("quantity"))
    )


@query("K10", "SELECT * FROM customer")
def snk_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, location = new_table(spark, "customer")
    return save_table(table(spark, sf_dir, "customer"), name, location)


@query("K11", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 400000")
def snk_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_view(table(spark, sf_dir, "orders"), "peneira_orders")
    return spark.sql("SELECT o_orderkey, o_totalprice FROM peneira_orders WHERE o_totalprice > 400000")


def _columns(name: str) -> int:
    sizes = {"region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6}
    return {**sizes, "lineitem": 11, "events": 6}[name]


@query(
    "K12",
    "\nUNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n_rows, {_columns(name)} AS n_columns, 0 AS n_rejected FROM {name}"
        for name in STAR_TABLES
    ),
)
def job_bulk_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = new_folder(spark, "raw")
    specs = {}
    for name in STAR_TABLES:
        rows = table(spark, sf_dir, name)
        write_csv(rows, f"{raw}/{name}", header=True)
        ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
        specs[name] = TableSpec(f"{raw}/{name}", ddl, options={"header": True})
    schema, _ = new_schema(spark)
    schema = f"{schema}_{uuid.uuid4().hex[:12]}"
    return bulk_load(spark, specs, schema, new_folder(spark, "loaded"))
