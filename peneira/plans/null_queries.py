"""Dropping, filling and defaulting nulls."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peneira.operators.nulls import cast_then_fill, fill, fill_then_cast, with_defaults
from peneira.plans.inputs import ORDERS_N, orders_n
from peneira.plans.registry import query
from peneira.sinks import register_view


@query(
    "N01",
    ORDERS_N
    + """SELECT * FROM orders_n WHERE o_orderkey IS NOT NULL AND origem IS NOT NULL
  AND dano IS NOT NULL AND valor IS NOT NULL AND lesoes IS NOT NULL""",
)
def nul_drop_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_n(spark, sf_dir).na.drop("any")


@query(
    "N02",
    ORDERS_N
    + """SELECT origem, dano, valor, lesoes FROM orders_n WHERE origem IS NOT NULL
  OR dano IS NOT NULL OR valor IS NOT NULL OR lesoes IS NOT NULL""",
)
def nul_drop_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_n(spark, sf_dir).drop("o_orderkey").na.drop("all")


@query(
    "N03",
    ORDERS_N
    + """SELECT * FROM orders_n WHERE (o_orderkey IS NOT NULL)::INT + (origem IS NOT NULL)::INT
  + (dano IS NOT NULL)::INT + (valor IS NOT NULL)::INT + (lesoes IS NOT NULL)::INT >= 4""",
)
def nul_drop_thresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_n(spark, sf_dir).na.drop(thresh=4)


@query("N04", ORDERS_N + "SELECT * FROM orders_n WHERE origem IS NOT NULL")
def nul_drop_subset_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_n(spark, sf_dir).na.drop(subset="origem")


@query("N05", ORDERS_N + "SELECT * FROM orders_n WHERE origem IS NOT NULL AND dano IS NOT NULL")
def nul_drop_subset_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    needed = ["origem", "dano"]
    return orders_n(spark, sf_dir).na.drop(subset=needed)


@query(
    "N06",
    ORDERS_N
    + "SELECT o_orderkey, coalesce(origem, 'Sem Origem') AS origem, dano, valor, lesoes FROM orders_n",
)
def nul_fill_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill(orders_n(spark, sf_dir), "Sem Origem", ["origem"])


@query(
    "N07",
    ORDERS_N
    + """SELECT o_orderkey, coalesce(origem, 'Sem Origem') AS origem, coalesce(dano, 'Sem Origem') AS dano,
  valor, coalesce(lesoes, 'Sem Origem') AS lesoes FROM orders_n""",
)
def nul_fill_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill(orders_n(spark, sf_dir), "Sem Origem")


@query(
    "N08",
    ORDERS_N + "SELECT o_orderkey, TRY_CAST(coalesce(lesoes, '0') AS INTEGER) AS lesoes FROM orders_n",
)
def nul_fill_then_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_then_cast(orders_n(spark, sf_dir).select("o_orderkey", "lesoes"), "lesoes")


@query(
    "N09",
    ORDERS_N + "SELECT o_orderkey, coalesce(TRY_CAST(lesoes AS INTEGER), 0) AS lesoes FROM orders_n",
)
def nul_cast_then_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cast_then_fill(orders_n(spark, sf_dir).select("o_orderkey", "lesoes"), "lesoes")


DEFAULTS_SQL = """SELECT o_orderkey, coalesce(origem, 'Sem Registro') AS origem,
  ifnull(dano, 'Sem Origem') AS dano, coalesce(valor, 0.0) AS valor, lesoes FROM """


@query("N10", ORDERS_N + DEFAULTS_SQL + "orders_n")
def nul_fill_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_defaults(
        orders_n(spark, sf_dir), {"origem": "Sem Registro", "dano": "Sem Origem", "valor": 0.0}
    )


@query("N10", ORDERS_N + DEFAULTS_SQL + "orders_n")
def nul_fill_defaults_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_view(orders_n(spark, sf_dir), "peneira_orders_n")
    return spark.sql(DEFAULTS_SQL + "peneira_orders_n").withColumn("valor", F.col("valor").cast("double"))
