"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peneira.functions.text import split_on, strip_accents
from peneira.plans.inputs import ORDERS_N, orders_n, padded, padded_sql, table
from peneira.plans.registry import query


@query("X01", "SELECT p_partkey, upper(p_name) AS result FROM part")
def fn_upper(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", F.upper("p_name").alias("result"))


@query("X02", "SELECT c_custkey, lower(c_name) AS name, lower(c_mktsegment) AS segment FROM customer")
def fn_lower(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey", F.lower("c_name").alias("name"), F.lower("c_mktsegment").alias("segment")
    )


def _padded_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", padded("p_name", "p_partkey").alias("name"))


@query("X03", f"SELECT p_partkey, '[' || trim({padded_sql('p_name', 'p_partkey')}) || ']' AS result FROM part")
def fn_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = F.concat(F.lit("["), F.trim("name"), F.lit("]"))
    return _padded_parts(spark, sf_dir).select("p_partkey", result.alias("result"))


@query("X04", f"SELECT p_partkey, '[' || ltrim({padded_sql('p_name', 'p_partkey')}) || ']' AS result FROM part")
def fn_ltrim(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = F.concat(F.lit("["), F.ltrim("name"), F.lit("]"))
    return _padded_parts(spark, sf_dir).select("p_partkey", result.alias("result"))


@query("X05", f"SELECT p_partkey, '[' || rtrim({padded_sql('p_name', 'p_partkey')}) || ']' AS result FROM part")
def fn_rtrim(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = F.concat(F.lit("["), F.rtrim("name"), F.lit("]"))
    return _padded_parts(spark, sf_dir).select("p_partkey", result.alias("result"))


@query("X06", "SELECT doc_id, regexp_replace(text, '[éèê]', 'e', 'g') AS result FROM documents")
def fn_regexp_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = F.regexp_replace("text", "[éèê]", "e")
    return table(spark, sf_dir, "documents").select("doc_id", result.alias("result"))


@query(
    "X07",
    "SELECT doc_id, translate(text, 'áàãâéèêíìóòõôúùûç', 'aaaaeeeiioooouuuc') AS result FROM documents",
)
def fn_translate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", strip_accents("text").alias("result"))


@query(
    "X09",
    ORDERS_N
    + """SELECT o_orderkey, coalesce(origem, dano, 'Sem Registro') AS result FROM orders_n""",
)
def fn_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = F.coalesce("origem", "dano", F.lit("Sem Registro"))
    return orders_n(spark, sf_dir).select("o_orderkey", result.alias("result"))


@query("X10", ORDERS_N + "SELECT o_orderkey, ifnull(origem, 'Sem Origem') AS result FROM orders_n")
def fn_ifnull(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = F.ifnull("origem", F.lit("Sem Origem"))
    return orders_n(spark, sf_dir).select("o_orderkey", result.alias("result"))


@query("X11", ORDERS_N + "SELECT o_orderkey, origem || ' ' || dano AS result FROM orders_n")
def fn_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = F.concat("origem", F.lit(" "), "dano")
    return orders_n(spark, sf_dir).select("o_orderkey", result.alias("result"))


@query("X12", "SELECT p_partkey, substring(p_name, 1, 3) AS result FROM part")
def fn_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", F.substring("p_name", 1, 3).alias("result"))


@query("X13", "SELECT conv_id, turn, CAST(length(text) AS INTEGER) AS n_chars FROM conversations")
def fn_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.length("text").alias("n_chars"))


@query("X14", "SELECT p_partkey, replace(p_brand, 'Brand#', 'Marca ') AS result FROM part")
def fn_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = F.replace("p_brand", F.lit("Brand#"), F.lit("Marca "))
    return table(spark, sf_dir, "part").select("p_partkey", result.alias("result"))


@query(
    "X15",
    """SELECT p_partkey, CAST(len(string_split(p_name, ' ')) AS INTEGER) AS n_parts,
  string_split(p_name, ' ')[1] AS first_part, string_split(p_name, ' ')[-1] AS last_part FROM part""",
)
def fn_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = split_on("p_name", " ")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.size(parts).alias("n_parts"),
        F.element_at(parts, 1).alias("first_part"),
        F.element_at(parts, -1).alias("last_part"),
    )


@query(
    "X16",
    "SELECT page_id, array_to_string(string_split(url, '/')[1:3], '/') AS result FROM pages",
)
def fn_substring_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.substring_index("url", "/", 3).alias("result"))


@query("X17", ORDERS_N + "SELECT o_orderkey, concat_ws(' ', origem, dano) AS result FROM orders_n")
def fn_concat_ws(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_n(spark, sf_dir).select("o_orderkey", F.concat_ws(" ", "origem", "dano").alias("result"))


@query(
    "X18",
    """SELECT p_partkey, CASE WHEN p_retailprice < 930 THEN 'barato'
  WHEN p_retailprice >= 930 AND p_retailprice < 970 THEN 'medio' ELSE 'caro' END AS faixa FROM part""",
)
def fn_case_when(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("p_retailprice")
    band = F.when(price < 930, "barato").when((price >= 930) & (price < 970), "medio").otherwise("caro")
    return table(spark, sf_dir, "part").select("p_partkey", band.alias("faixa"))
