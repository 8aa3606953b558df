"""Table profile and format comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peneira.operators.combine import flatten
from peneira.operators.profile import ROWS_PER_FILE, compare_formats, read_format, table_profile
from peneira.plans.inputs import ORDERS_N, orders_n, table
from peneira.plans.registry import query
from peneira.workspace import new_folder

FEW = 100  # distinct values up to which the estimate is exact
ROWS_AT_ONCE = 12_000_000  # of a format that are on disk together, unless there are more cores than files of them


@query(
    "M01",
    ORDERS_N
    + "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, {i} AS position, '{kind}' AS data_type, "
        f"count(*) - count({c}) AS n_nulls, "
        f"CASE WHEN count(DISTINCT {c}) <= {FEW} THEN count(DISTINCT {c}) END AS n_distinct, "
        f"{'abs(count(DISTINCT ' + c + ') - count(*)) <= 0.1 * count(*)' if c == 'o_orderkey' else 'NULL'} AS looks_like_key "
        f"FROM orders_n"
        for i, (c, kind) in enumerate(
            [
                ("o_orderkey", "bigint"),
                ("origem", "string"),
                ("dano", "string"),
                ("valor", "double"),
                ("lesoes", "string"),
            ]
        )
    ),
)
def prf_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pass; distinct values are estimates, exact for few and within a tenth for a key."""
    profile = table_profile(orders_n(spark, sf_dir))
    near = F.abs(F.col("n_distinct") - F.col("n_rows")) <= 0.1 * F.col("n_rows")
    return profile.select(
        "column_name",
        "position",
        "data_type",
        "n_nulls",
        F.when(F.col("n_distinct") <= FEW, F.col("n_distinct")).alias("n_distinct"),
        F.when(F.col("column_name") == "o_orderkey", near).alias("looks_like_key"),
    )


@query(
    "M02",
    "\nUNION ALL ".join(
        f"SELECT '{name}' AS format, '{compression}' AS compression, count(*) AS n_rows, sum(l_orderkey) AS keys, "
        "sum(l_quantity) AS quantity, count(DISTINCT l_returnflag) AS flags FROM lineitem"
        for name in ("parquet", "csv", "json")
        for compression in ("default", "gzip")
    ),
)
def prf_format_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the files of each format hold, read back; their bytes and seconds are for the bench."""
    lines, folder = table(spark, sf_dir, "lineitem"), new_folder(spark, "formats")
    parts = [
        F.count("*").alias("n_rows"),
        F.sum("l_orderkey").alias("keys"),
        F.sum("l_quantity").alias("quantity"),
    ]
    by = ["l_returnflag"]
    at_once = max(ROWS_AT_ONCE, ROWS_PER_FILE * spark.sparkContext.defaultParallelism)
    compare_formats(lines, folder, parts, by=by, rows_at_once=at_once)
    schema = lines.groupBy(*by).agg(*parts).schema
    whole = [
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        F.sum("keys").alias("keys"),
        F.sum("quantity").alias("quantity"),
        F.count_distinct(*by).alias("flags"),
    ]
    return flatten(
        [
            read_format(spark, f"{folder}/contents-{name}-{compression}", "parquet", schema)
            .agg(*whole)
            .select(F.lit(name).alias("format"), F.lit(compression).alias("compression"), "*")
            for name in ("parquet", "csv", "json")
            for compression in ("default", "gzip")
        ]
    )
