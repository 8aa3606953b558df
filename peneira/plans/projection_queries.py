"""Projections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peneira.functions.text import split_on
from peneira.operators.projections import at, cast_with_rejects, explode_tokens, key_value, rename
from peneira.plans.inputs import TOKENS, table
from peneira.plans.registry import query


@query("P01", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def prj_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = ["c_custkey", "c_name", "c_mktsegment"]
    return table(spark, sf_dir, "customer").select(wanted)


@query("P02", "SELECT o_orderkey AS pedido, o_orderstatus AS fase, o_orderpriority AS tipo FROM orders")
def prj_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("pedido"),
        F.col("o_orderstatus").alias("fase"),
        F.col("o_orderpriority").alias("tipo"),
    )


@query(
    "P03",
    """SELECT p_partkey, upper(p_type) AS p_type, p_size, p_size * 10 AS size_mm,
  p_retailprice >= 950 AS is_costly FROM part""",
)
def prj_with_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size", "p_retailprice")
    return parts.withColumns(
        {
            "p_type": F.upper("p_type"),
            "size_mm": F.col("p_size") * 10,
            "is_costly": F.col("p_retailprice") >= 950,
        }
    ).drop("p_retailprice")


@query(
    "P04",
    """SELECT c_custkey AS id, c_name AS nome, c_nationkey, c_acctbal AS saldo, c_mktsegment AS segmento
FROM customer""",
)
def prj_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rename(
        table(spark, sf_dir, "customer"),
        {"c_custkey": "id", "c_name": "nome", "c_acctbal": "saldo", "c_mktsegment": "segmento"},
    )


@query("P05", "SELECT l_suppkey AS key, CAST(trunc(l_quantity) AS INTEGER) AS value FROM lineitem")
def prj_key_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_value(table(spark, sf_dir, "lineitem"), "l_suppkey", F.col("l_quantity").cast("int"))


@query("P06", TOKENS + "SELECT token, count(*) AS n FROM tokens GROUP BY token")
def prj_flatmap_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = explode_tokens(table(spark, sf_dir, "documents"), "text")
    return words.groupBy("token").agg(F.count("*").alias("n"))


@query(
    "P07",
    "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '2-HIGH'",
)
def prj_dynamic_ref(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    first, second = "o_orderstatus", "o_orderpriority"
    return orders.filter((orders[first] == "F") & (F.col(second) == "2-HIGH")).select(
        orders.o_orderkey, first
    )


@query("P08", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'P'")
def prj_by_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    position = orders.columns.index("o_orderstatus")
    return orders.filter(at(orders, position) == "P").select(at(orders, 0), at(orders, position))


@query(
    "P09",
    """SELECT p_partkey AS id, 'brand' AS kind, TRY_CAST(string_split(p_brand, '#')[-1] AS INTEGER) AS parsed
FROM part
UNION ALL
SELECT p_partkey, 'name', TRY_CAST(string_split(p_name, ' ')[-1] AS INTEGER) FROM part""",
)
def prj_cast_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    ends = [
        F.struct(F.lit(kind).alias("kind"), F.element_at(split_on(source, sep), -1).alias("parsed"))
        for kind, source, sep in [("brand", "p_brand", "#"), ("name", "p_name", " ")]
    ]
    texts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.inline(F.array(*ends)))
    converted, _ = cast_with_rejects(texts, "parsed", "int")
    return converted


@query(
    "P09",
    """SELECT p_partkey AS id, string_split(p_name, ' ')[-1] AS parsed FROM part
WHERE p_partkey % 3 = 0 AND TRY_CAST(string_split(p_name, ' ')[-1] AS INTEGER) IS NULL""",
)
def prj_cast_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of numbers, nulls and words, the words."""
    part = F.col("p_partkey")
    text = (
        F.when(part % 3 == 0, F.element_at(split_on("p_name", " "), -1))
        .when(part % 3 == 1, part.cast("string"))
        .otherwise(F.lit(None).cast("string"))
    )
    ends = table(spark, sf_dir, "part").select(part.alias("id"), text.alias("parsed"))
    _, rejects = cast_with_rejects(ends, "parsed", "int")
    return rejects


@query("P10", "SELECT p_partkey, 'Classificacao' AS classificacao, 1 AS versao FROM part")
def prj_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.lit("Classificacao").alias("classificacao"), F.lit(1).alias("versao")
    )
