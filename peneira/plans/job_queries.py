"""Jobs of several steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peneira.functions.text import standardise
from peneira.operators.nulls import cast_then_fill, with_defaults
from peneira.plans.inputs import ORDERS_N, orders_n, table
from peneira.plans.registry import query
from peneira.sinks import register_view, write_csv, write_partitioned
from peneira.sources import read_csv, read_parquet
from peneira.workspace import new_folder

FOLD_SQL = "trim(translate(lower({}), 'áàãâéèêíìóòõôúùûç', 'aaaaeeeiioooouuuc'))"


@query(
    "X08",
    f"""SELECT lang, count(*) AS n_docs, count(DISTINCT text) AS n_texts,
  count(DISTINCT {FOLD_SQL.format("text")}) AS n_standard FROM documents GROUP BY lang""",
)
def job_standardise_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts per language that still differ once written in the standard form."""
    # Digests instead of whole texts keep the shuffle small.
    texts = table(spark, sf_dir, "documents").select(
        "lang",
        F.sha2("text", 256).alias("as_is"),
        F.sha2(standardise("text"), 256).alias("standard"),
    )
    return texts.groupBy("lang").agg(
        F.count("*").alias("n_docs"),
        F.count_distinct("as_is").alias("n_texts"),
        F.count_distinct("standard").alias("n_standard"),
    )


@query(
    "K12",
    ORDERS_N
    + """SELECT coalesce(lower(origem), 'sem origem') AS origem, coalesce(dano, 'Sem Registro') AS dano,
  count(*) AS n_rows, sum(coalesce(TRY_CAST(lesoes AS INTEGER), 0)) :: BIGINT AS lesoes,
  round(sum(valor), 2) AS valor
FROM orders_n WHERE coalesce(dano, 'Sem Registro') <> 'F' GROUP BY 1, 2""",
)
def job_raw_to_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw CSV, standardised, nulls filled, published by partition, reported in SQL."""
    raw = new_folder(spark, "raw-orders")
    rows = orders_n(spark, sf_dir)
    write_csv(rows, raw, header=True, sep=";")
    loaded = read_csv(spark, raw, header=True, sep=";", schema=rows.schema)
    clean = cast_then_fill(loaded.withColumn("origem", standardise("origem")), "lesoes")
    filled = with_defaults(clean, {"origem": "sem origem", "dano": "Sem Registro"})
    published = new_folder(spark, "published-orders")
    write_partitioned(filled, published, ["dano"])
    register_view(read_parquet(spark, published, filled.schema), "peneira_published_orders")
    return spark.sql(
        """SELECT origem, dano, count(*) AS n_rows, sum(lesoes) AS lesoes, round(sum(valor), 2) AS valor
        FROM peneira_published_orders WHERE dano <> :hidden GROUP BY origem, dano""",
        args={"hidden": "F"},
    )
