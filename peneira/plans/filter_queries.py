"""Filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peneira.functions.predicates import (
    all_of,
    any_of,
    closed,
    differs,
    equals_ignoring_case,
    equals_standardised,
    equals_trimmed,
    half_open,
    keep_listed,
)
from peneira.operators.projections import explode_tokens
from peneira.plans.inputs import ORDERS_N, TOKENS, orders_n, padded, padded_sql, table
from peneira.plans.registry import query
from peneira.sinks import register_view

WORDS = ["the", "and", "que", "de", "der", "la"]


@query("F01", "SELECT * FROM orders WHERE o_orderstatus = 'F'")
def flt_text_eq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")


@query("F02", "SELECT * FROM lineitem WHERE l_linenumber = 1")
def flt_num_eq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").filter(F.col("l_linenumber") == 1)


@query("F03", ORDERS_N + "SELECT * FROM orders_n WHERE dano <> 'F'")
def flt_not_eq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_n(spark, sf_dir).filter(differs("dano", "F"))


@query("F03", ORDERS_N + "SELECT * FROM orders_n WHERE dano IS DISTINCT FROM 'F'")
def flt_not_eq_keep_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_n(spark, sf_dir).filter(differs("dano", "F", keep_null=True))


@query(
    "F04",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax FROM lineitem
WHERE l_quantity > 45 AND l_discount < 0.05 AND l_tax >= 0.02""",
)
def flt_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    wanted = all_of(F.col("l_quantity") > 45, F.col("l_discount") < 0.05, F.col("l_tax") >= 0.02)
    return lines.filter(wanted).select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")


@query("F05", "SELECT * FROM orders WHERE o_totalprice >= 30000 AND o_totalprice < 200000")
def flt_range_half_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").filter(half_open("o_totalprice", 30000, 200000))


@query("F06", "SELECT * FROM part WHERE p_retailprice BETWEEN 910 AND 950")
def flt_range_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    low, high = 910, 950
    return table(spark, sf_dir, "part").filter(closed("p_retailprice", low, high))


@query("F07", "SELECT * FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority = '1-URGENT'")
def flt_and(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where(
        all_of(F.col("o_orderstatus") == "O", F.col("o_orderpriority") == "1-URGENT")
    )


@query("F08", "SELECT * FROM orders WHERE o_orderstatus = 'P' OR o_orderpriority = '5-LOW'")
def flt_or(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").filter(
        any_of(F.col("o_orderstatus") == "P", F.col("o_orderpriority") == "5-LOW")
    )


@query(
    "F09",
    TOKENS
    + """SELECT token, count(*) AS n FROM tokens
WHERE token IN ('the', 'and', 'que', 'de', 'der', 'la') GROUP BY token""",
)
def flt_in_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = keep_listed(explode_tokens(table(spark, sf_dir, "documents"), "text"), "token", WORDS)
    return found.groupBy("token").agg(F.count("*").alias("n"))


@query(
    "F09",
    """SELECT c_custkey, c_name FROM customer WHERE c_name IN (
  SELECT 'Customer#' || lpad(CAST(i AS VARCHAR), 9, '0') FROM range(400, 2400) AS listed(i))""",
)
def flt_in_long_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = [f"Customer#{i:09d}" for i in range(400, 2400)]
    return keep_listed(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), "c_name", listed)


@query(
    "F09",
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IN (
  SELECT l_orderkey FROM lineitem WHERE l_quantity >= 49 AND l_orderkey BETWEEN 200 AND 20000)""",
)
def flt_in_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list is a table's column; its range reaches the scan of the orders."""
    large = table(spark, sf_dir, "lineitem").filter((F.col("l_quantity") >= 49) & F.col("l_orderkey").between(200, 20000))
    return keep_listed(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", large.select("l_orderkey"))


@query("F10", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%ed%'")
def flt_like_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").filter(F.col("p_name").like("%ed%")).select("p_partkey", "p_name")


@query("F10", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'small%'")
def flt_like_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").filter(F.col("p_name").like("small%")).select("p_partkey", "p_name")


@query("F10", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%bolt'")
def flt_like_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").filter(F.col("p_name").like("%bolt")).select("p_partkey", "p_name")


@query("F11", ORDERS_N + "SELECT * FROM orders_n WHERE origem IS NULL")
def flt_is_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_n(spark, sf_dir).filter(F.col("origem").isNull())


@query("F12", ORDERS_N + "SELECT * FROM orders_n WHERE lesoes IS NOT NULL")
def flt_is_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_n(spark, sf_dir).filter(F.col("lesoes").isNotNull())


@query("F13", "SELECT * FROM orders WHERE lower(o_orderpriority) = '1-urgent'")
def flt_case_insensitive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").filter(equals_ignoring_case("o_orderpriority", "1-Urgent"))


@query(
    "F14",
    "\nUNION ALL ".join(
        f"SELECT c_custkey, '{side}' AS side FROM customer "
        f"WHERE {call}({padded_sql('c_mktsegment', 'c_custkey')}) = 'BUILDING'"
        for side, call in [("both", "trim"), ("left", "ltrim"), ("right", "rtrim")]
    ),
)
def flt_trimmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", padded("c_mktsegment", "c_custkey").alias("segment")
    )
    # One scan: each row is asked for all three sides.
    sides = [
        F.when(equals_trimmed("segment", "BUILDING", side), F.lit(side)) for side in ("both", "left", "right")
    ]
    return customers.select("c_custkey", F.explode(F.array_compact(F.array(*sides))).alias("side"))


@query(
    "F15",
    TOKENS
    + """SELECT token, count(*) AS n FROM tokens
WHERE trim(translate(lower(token), 'áàãâéèêíìóòõôúùûç', 'aaaaeeeiioooouuuc')) = 'a' GROUP BY token""",
)
def flt_accent_insensitive(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = explode_tokens(table(spark, sf_dir, "documents"), "text")
    return words.filter(equals_standardised("token", "À")).groupBy("token").agg(F.count("*").alias("n"))


@query(
    "F16",
    """SELECT o_orderkey AS pedido, o_orderpriority AS prioridade FROM orders
WHERE o_orderstatus = 'O' AND o_orderpriority = '2-HIGH' AND o_totalprice > 100000""",
)
def flt_sql_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_view(table(spark, sf_dir, "orders"), "peneira_orders_query")
    return spark.sql(
        """SELECT o_orderkey AS pedido, o_orderpriority AS prioridade FROM peneira_orders_query
        WHERE o_orderstatus = :status AND o_orderpriority = :priority AND o_totalprice > :above""",
        args={"status": "O", "priority": "2-HIGH", "above": 100000},
    )
