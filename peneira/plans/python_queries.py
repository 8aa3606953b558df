"""Operators that take a Python function."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peneira.operators.projections import explode_tokens
from peneira.operators.python_functions import combine_per_key, flat_map, for_each_record, keep_if, map_values
from peneira.plans.inputs import TOKENS, table
from peneira.plans.registry import query


@query("V01", "SELECT p_partkey, upper(p_brand) || ':' || reverse(p_type) AS result FROM part")
def udf_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = map_values(lambda brand, kind: f"{brand.upper()}:{kind[::-1]}", "string", "p_brand", "p_type")
    return table(spark, sf_dir, "part").select("p_partkey", label.alias("result"))


def _is_listed(word: str) -> bool | None:
    if word in ("the", "and", "que", "de"):
        return True
    return None


@query(
    "V02",
    TOKENS
    + "SELECT token, count(*) AS n FROM tokens WHERE token IN ('the', 'and', 'que', 'de') GROUP BY token",
)
def udf_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The predicate looks at the word alone, so each distinct word is asked once.
    words = explode_tokens(table(spark, sf_dir, "documents"), "text")
    counted = words.groupBy("token").agg(F.count("*").alias("n"))
    return keep_if(counted, _is_listed, "token", pinned=True)


def _words(text: str) -> Iterable[str]:
    return (word for line in text.split("\n") for word in line.split(" "))


@query("V03", TOKENS + "SELECT token, count(*) AS n FROM tokens GROUP BY token")
def udf_flatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = flat_map(table(spark, sf_dir, "documents"), _words, "text", "token", "string")
    return words.groupBy("token").agg(F.count("*").alias("n"))


class LargeLines:
    """Emits a line's supplier and quantity if the quantity is large, else nothing."""

    def __init__(self, above: float) -> None:
        self.above = above

    def process(self, line: tuple) -> list[tuple] | None:
        if line.l_quantity > self.above:
            return [(line.l_orderkey, line.l_linenumber, line.l_quantity)]
        return None


@query(
    "V04",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 45",
)
def udf_pardo(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return for_each_record(
        lines, LargeLines(45).process, "l_orderkey long, l_linenumber int, l_quantity double"
    )


@query("V05", "SELECT l_suppkey, sum(l_quantity) AS l_quantity FROM lineitem GROUP BY l_suppkey")
def udf_combine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return combine_per_key(table(spark, sf_dir, "lineitem"), "l_suppkey", "l_quantity", sum)


@query("V05", "SELECT l_suppkey, sum(l_quantity) AS l_quantity FROM lineitem GROUP BY l_suppkey")
def udf_combine_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return combine_per_key(table(spark, sf_dir, "lineitem"), "l_suppkey", "l_quantity", "sum")
