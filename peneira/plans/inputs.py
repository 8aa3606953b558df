"""The test tables and the views derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with nulls and bad numbers in four derived columns."""
    customer = F.col("o_custkey")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderpriority")).alias("origem"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("dano"),
        F.when(F.col("o_totalprice") >= 50000, F.col("o_totalprice")).alias("valor"),
        F.when(customer % 5 == 0, F.lit(None).cast("string"))
        .when(customer % 97 == 0, F.lit("x"))
        .otherwise((customer % 4).cast("string"))
        .alias("lesoes"),
    )


# The same view for the SQL twins.
ORDERS_N = """WITH orders_n AS (
  SELECT o_orderkey,
         CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority END AS origem,
         CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS dano,
         CASE WHEN o_totalprice >= 50000 THEN o_totalprice END AS valor,
         CASE WHEN o_custkey % 5 = 0 THEN NULL
              WHEN o_custkey % 97 = 0 THEN 'x'
              ELSE CAST(o_custkey % 4 AS VARCHAR) END AS lesoes
  FROM orders)
"""


def padded(text: str, key: str) -> Column:
    """Text with a blank before it, after it, on both ends or on none, by key."""
    rest = F.col(key) % 4
    before = F.when(rest.isin(1, 3), F.lit(" ")).otherwise("")
    after = F.when(rest.isin(2, 3), F.lit(" ")).otherwise("")
    return F.concat(before, F.col(text), after)


def padded_sql(text: str, key: str) -> str:
    return (
        f"(CASE WHEN {key} % 4 IN (1, 3) THEN ' ' ELSE '' END || {text} || "
        f"CASE WHEN {key} % 4 IN (2, 3) THEN ' ' ELSE '' END)"
    )


# One row per line, and per blank-separated word of each line, of the documents.
LINES = """WITH ends AS (
  SELECT unnest(string_split(text, chr(10))) AS line FROM documents),
lines AS (
  SELECT CASE WHEN ends_with(line, chr(13)) THEN left(line, -1) ELSE line END AS line FROM ends)
"""
TOKENS = """WITH lines AS (
  SELECT unnest(string_split(text, chr(10))) AS line FROM documents),
tokens AS (
  SELECT unnest(string_split(line, ' ')) AS token FROM lines)
"""
