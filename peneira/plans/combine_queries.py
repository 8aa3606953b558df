"""Co-group and flatten."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peneira.operators.combine import align, co_group, flatten, tagged_rows
from peneira.operators.projections import key_value
from peneira.plans.inputs import table
from peneira.plans.registry import query

BLOCK_SIZE = 10_000
SMALL_BLOCK = 5


def _cogroup_sql(block_size: int) -> str:
    return f"""WITH tagged AS (
  SELECT o_custkey AS k, 'urgent' AS tag, o_orderkey AS v FROM orders WHERE o_orderpriority = '1-URGENT'
  UNION ALL
  SELECT o_custkey, 'open', o_orderkey FROM orders WHERE o_orderstatus = 'O'),
sizes AS (
  SELECT k, CAST(ceil(max(n) / {block_size}.0) AS BIGINT) AS blocks
  FROM (SELECT k, tag, count(*) AS n FROM tagged GROUP BY k, tag) GROUP BY k)
SELECT k AS custkey, v % blocks AS block,
  coalesce(string_agg(CAST(v AS VARCHAR), ',' ORDER BY v) FILTER (WHERE tag = 'urgent'), '') AS urgent_orders,
  coalesce(string_agg(CAST(v AS VARCHAR), ',' ORDER BY v) FILTER (WHERE tag = 'open'), '') AS open_orders
FROM tagged JOIN sizes USING (k) GROUP BY k, v % blocks"""


def _cogrouped(spark: SparkSession, sf_dir: str, block_size: int) -> DataFrame:
    conditions = {
        "urgent": (F.col("o_orderpriority") == "1-URGENT", "o_orderkey"),
        "open": (F.col("o_orderstatus") == "O", "o_orderkey"),
    }
    rows = tagged_rows(table(spark, sf_dir, "orders"), "o_custkey", conditions)
    grouped = co_group(rows, block_size, spread_by=F.col("value"), tags=list(conditions))
    text = lambda c: F.array_join(F.col(c).cast("array<string>"), ",")
    return grouped.select(
        F.col("key").alias("custkey"),
        "block",
        text("urgent").alias("urgent_orders"),
        text("open").alias("open_orders"),
    )


@query("J01", _cogroup_sql(BLOCK_SIZE))
def cmb_cogroup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cogrouped(spark, sf_dir, BLOCK_SIZE)


@query("J01", _cogroup_sql(SMALL_BLOCK))
def cmb_cogroup_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks so small that most customers have several."""
    return _cogrouped(spark, sf_dir, SMALL_BLOCK)


@query(
    "J01",
    """WITH tagged AS (
  SELECT l_suppkey AS k, l_quantity AS v FROM lineitem WHERE l_returnflag = 'R')
SELECT k AS suppkey, count(*) AS n_lines, sum(v) AS quantity FROM tagged GROUP BY k""",
)
def cmb_cogroup_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A count per key beside a sum per key."""
    returned = key_value(
        table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R"), "l_suppkey", "l_quantity"
    )
    counts = returned.groupBy("key").agg(F.count("*").cast("double").alias("value"))
    sums = returned.groupBy("key").agg(F.sum("value").alias("value"))
    return align({"counts": counts, "sums": sums}).select(
        F.col("key").alias("suppkey"), F.col("counts").cast("long").alias("n_lines"), F.col("sums").alias("quantity")
    )


@query(
    "U01",
    "\nUNION ALL ".join(
        f"SELECT c_name FROM customer WHERE c_mktsegment = '{segment}'"
        for segment in ["BUILDING", "MACHINERY", "FURNITURE"]
    ),
)
def set_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    return flatten(
        [
            customers.filter(F.col("c_mktsegment") == segment).select("c_name")
            for segment in ["BUILDING", "MACHINERY", "FURNITURE"]
        ]
    )
