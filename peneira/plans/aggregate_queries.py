"""Aggregates, sorts and previews."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peneira.operators.aggregates import (
    count_per_key,
    count_where,
    first_rows,
    null_counts,
    ranked_counts,
    row_count,
    sum_per_key,
    summary_per_key,
)
from peneira.plans.inputs import ORDERS_N, orders_n, table
from peneira.plans.registry import query


@query(
    "A01",
    """SELECT l_suppkey, sum(l_quantity) AS quantity FROM lineitem
WHERE l_returnflag = 'R' GROUP BY l_suppkey""",
)
def agg_sum_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    returned = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R")
    return sum_per_key(returned, "l_suppkey", "l_quantity", "quantity")


@query("A02", "SELECT event_type, count(*) AS n_rows FROM events GROUP BY event_type")
def agg_count_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_per_key(table(spark, sf_dir, "events"), "event_type")


@query("A03", "SELECT count(*) AS n_rows FROM lineitem")
def agg_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_count(table(spark, sf_dir, "lineitem"))


@query("A04", "SELECT p_type, count(p_partkey) AS qtd FROM part GROUP BY p_type ORDER BY qtd DESC")
def agg_group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_counts(table(spark, sf_dir, "part"), "p_type", "p_partkey", "qtd")


@query("A05", "SELECT DISTINCT l_returnflag, lower(l_linestatus) AS status FROM lineitem")
def agg_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return lines.select("l_returnflag", F.lower("l_linestatus").alias("status")).distinct()


@query(
    "A06",
    ORDERS_N
    + """SELECT count(*) FILTER (WHERE origem IS NULL) AS no_origin,
  count(*) FILTER (WHERE dano IS NULL AND lesoes IS NULL) AS no_damage FROM orders_n""",
)
def agg_count_if(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_where(
        orders_n(spark, sf_dir),
        no_origin=F.col("origem").isNull(),
        no_damage=F.col("dano").isNull() & F.col("lesoes").isNull(),
    )


@query(
    "A07",
    ORDERS_N
    + "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_nulls FROM orders_n"
        for c in ["o_orderkey", "origem", "dano", "valor", "lesoes"]
    ),
)
def agg_null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_counts(orders_n(spark, sf_dir))


@query(
    "A08",
    """SELECT l_suppkey, count(*) AS n_lines, sum(l_quantity) AS quantity FROM lineitem
WHERE l_returnflag = 'R' GROUP BY l_suppkey ORDER BY quantity DESC, l_suppkey""",
)
def agg_delay_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late flights per destination, here returned lines per supplier."""
    summary = summary_per_key(
        table(spark, sf_dir, "lineitem"),
        "l_suppkey",
        "l_quantity",
        where=F.col("l_returnflag") == "R",
        count_name="n_lines",
        sum_name="quantity",
    )
    return summary.orderBy(F.desc("quantity"), "l_suppkey")


@query("O01", "SELECT o_custkey, count(o_orderkey) AS qtd FROM orders GROUP BY o_custkey ORDER BY qtd DESC")
def srt_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_counts(table(spark, sf_dir, "orders"), "o_custkey", "o_orderkey", "qtd")


@query("O02", "SELECT * FROM customer ORDER BY c_custkey LIMIT 20")
def lim_first_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_rows(table(spark, sf_dir, "customer"), 20, "c_custkey")
