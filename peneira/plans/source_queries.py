"""Every source, on files written from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peneira.plans.inputs import LINES, table
from peneira.plans.registry import query
from peneira.plans.sink_queries import new_table
from peneira.sinks import save_table, write_csv, write_json, write_parquet, write_partitioned, write_text
from peneira.sources import (
    inline_rows,
    read_csv,
    read_csv_with_preamble,
    read_json,
    read_lines,
    read_parquet,
    read_partition,
    split_fields,
    spread,
)
from peneira.workspace import new_folder

SEGMENTS = [("BUILDING", "construction"), ("MACHINERY", "industry"), ("FURNITURE", "home")]


@query(
    "S01",
    LINES
    + """SELECT length(line) // 20 * 20 AS length_class, count(*) AS n_lines
FROM lines GROUP BY 1""",
)
def src_text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "text-lines")
    write_text(table(spark, sf_dir, "documents").select("text"), path, strict=False)  # a text has many lines
    length_class = F.expr("length(value) div 20 * 20").alias("length_class")
    return read_lines(spark, path).groupBy(length_class).agg(F.count("*").alias("n_lines"))


@query("S02", "SELECT * FROM orders")
def src_skip_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    path = new_folder(spark, "skip-header")
    write_csv(orders, path, header=True)
    return read_csv(spark, path, header=True, schema=orders.schema)


@query("S02", "SELECT CAST(o_orderkey AS VARCHAR) || ',' || o_orderpriority AS value FROM orders")
def src_skip_first_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    path = new_folder(spark, "skip-first-line")
    write_csv(orders, path, header=True)
    return read_lines(spark, path, skip=1)


@query("S03", "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def src_delimited_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"
    )
    path = new_folder(spark, "delimited")
    write_text(orders, path, sep=",")
    rows = read_lines(spark, path).select(*split_fields("value", ",", orders.columns))
    return rows.withColumns(
        {"o_orderkey": F.col("o_orderkey").cast("long"), "o_totalprice": F.col("o_totalprice").cast("double")}
    )


@query(
    "S04",
    """SELECT c_custkey, c_mktsegment FROM customer
WHERE c_mktsegment IN (SELECT segment FROM (VALUES
  ('BUILDING', 'construction'), ('MACHINERY', 'industry'), ('FURNITURE', 'home')) AS inline(segment, label)
  WHERE label <> 'home')""",
)
def src_inline_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = inline_rows(spark, SEGMENTS, "c_mktsegment string, label string").filter(F.col("label") != "home")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return customers.join(wanted, "c_mktsegment", "left_semi").select("c_custkey", "c_mktsegment")


@query("S05", "SELECT * FROM customer")
def src_csv_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    path = new_folder(spark, "csv-header")
    write_csv(customers, path, header=True)
    return read_csv(spark, path, header=True, schema=customers.schema)


@query(
    "S05",
    """SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, CAST(c_nationkey AS INTEGER) AS c_nationkey,
  c_mktsegment, CAST(c_acctbal AS DOUBLE) AS c_acctbal, 'int,string,int,double,string' AS kinds FROM customer""",
)
def src_csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names from the header, types from the data."""
    path = new_folder(spark, "csv-inferred")
    write_csv(table(spark, sf_dir, "customer"), path, header=True)
    return _with_kinds(read_csv(spark, path, header=True))


def _with_kinds(rows: DataFrame) -> DataFrame:
    return rows.withColumn("kinds", F.lit(",".join(kind for _, kind in rows.dtypes)))


@query("S06", "SELECT * FROM supplier")
def src_csv_semicolon(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier")
    path = new_folder(spark, "csv-semicolon")
    write_csv(suppliers, path, header=True, sep=";")
    options = {"sep": ";", "mode": "FAILFAST"}
    return read_csv(spark, path, header=True, schema=suppliers.schema, **options)


@query("S07", "SELECT * FROM customer")
def src_csv_preamble(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    path = new_folder(spark, "csv-preamble")
    _write_with_preamble(customers, path, "Updated: 2024-01-01", ";")
    return read_csv_with_preamble(spark, path, customers.schema, preamble=1, sep=";")


@query(
    "S07",
    """SELECT CAST(s_suppkey AS INTEGER) AS s_suppkey, s_name, CAST(s_nationkey AS INTEGER) AS s_nationkey,
  CAST(s_acctbal AS DOUBLE) AS s_acctbal, 'int,string,int,double' AS kinds FROM supplier""",
)
def src_csv_preamble_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names from the header line below the preamble, types from the data."""
    path = new_folder(spark, "csv-preamble-inferred")
    _write_with_preamble(table(spark, sf_dir, "supplier"), path, "Updated: 2024-01-01", ";")
    return _with_kinds(read_csv_with_preamble(spark, path, preamble=1, sep=";"))


def _write_with_preamble(df: DataFrame, path: str, preamble: str, sep: str) -> None:
    """Text files that open with a preamble line and a header line each."""
    line = F.concat_ws(sep, *df.columns)
    row_in_task = F.monotonically_increasing_id().bitwiseAND(2**33 - 1)
    head = f"{preamble}\n{sep.join(df.columns)}\n"
    opened = F.when(row_in_task == 0, F.concat(F.lit(head), line)).otherwise(line)
    write_text(df.select(opened.alias("value")), path, strict=False)


@query(
    "S08",
    """SELECT CAST(s_suppkey AS INTEGER) AS _c0, s_name AS _c1, s_nationkey AS _c2, s_acctbal AS _c3 FROM supplier""",
)
def src_csv_noheader(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "csv-noheader")
    write_csv(table(spark, sf_dir, "supplier"), path)
    return read_csv(spark, path, header=False)


@query("S09", "SELECT * FROM events")
def src_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    path = new_folder(spark, "json")
    write_json(events, path)
    return read_json(spark, path, events.schema)


@query(
    "S09",
    "SELECT s_acctbal, s_name, s_nationkey, s_suppkey, 'double,string,bigint,bigint' AS kinds FROM supplier",
)
def src_json_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No schema: columns by name, types from the data."""
    path = new_folder(spark, "json-inferred")
    write_json(table(spark, sf_dir, "supplier"), path)
    return _with_kinds(read_json(spark, path))


@query("S10", "SELECT * FROM lineitem")
def src_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/lineitem.parquet")


@query("S11", "SELECT * FROM part")
def src_gzip_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    path = new_folder(spark, "gzip-csv")
    write_csv(parts, path, header=True, compression="gzip")
    return spread(read_csv(spark, path, header=True, schema=parts.schema))


@query("S11", "SELECT * FROM part")
def src_gzip_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    path = new_folder(spark, "gzip-json")
    write_json(parts, path, compression="gzip")
    return read_json(spark, path, parts.schema)


@query("S11", "SELECT * FROM part")
def src_gzip_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "gzip-parquet")
    write_parquet(table(spark, sf_dir, "part"), path, compression="gzip")
    return read_parquet(spark, path)


@query("S12", "SELECT * FROM orders")
def src_dir_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    path = new_folder(spark, "dir-parts")
    files = max(4, spark.sparkContext.defaultParallelism)
    write_csv(orders.repartition(files, "o_orderkey"), path, header=True)
    return read_csv(spark, path, header=True, schema=orders.schema)


@query("S13", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def src_partitioned_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    path = new_folder(spark, "partitioned")
    write_partitioned(orders, path, ["o_orderstatus"])
    return read_parquet(spark, path, orders.schema)


LINE_COLUMNS = ["l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag", "l_linestatus"]


@query(
    "S14",
    f"SELECT {', '.join(LINE_COLUMNS)} FROM lineitem WHERE l_returnflag = 'R'",
)
def src_partition_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS)
    path = new_folder(spark, "partition-one")
    write_partitioned(lines, path, ["l_returnflag"])
    return read_partition(spark, path, {"l_returnflag": "R"}, lines.schema)


@query(
    "S14",
    f"SELECT {', '.join(LINE_COLUMNS)} FROM lineitem WHERE l_returnflag = 'A' AND l_linestatus = 'F'",
)
def src_partition_two_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS)
    path = new_folder(spark, "partition-two")
    write_partitioned(lines, path, ["l_returnflag", "l_linestatus"])
    return read_partition(spark, path, {"l_returnflag": "A", "l_linestatus": "F"}, lines.schema)


@query("S15", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def src_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, location = new_table(spark, "customer")
    save_table(table(spark, sf_dir, "customer"), name, location)
    return spark.table(name).select("c_custkey", "c_name", "c_acctbal")
