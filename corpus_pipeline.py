"""From raw documents to packed training sequences, one stage after the other.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
to the shared folder and read back as the next stage's documents. All but the last
return the columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peneira.llm import decontaminate, language, near_duplicates, queries, secret_scan
from peneira.llm.common import is_held_out, stored
from peneira.plans.inputs import table

LEAST_SCORE = 0.2  # of a document's language


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the filters know with a score of ``LEAST_SCORE`` or more.

    So these go: texts that are null or have no letter, and those of which less than that share of the
    letter 3-grams belongs to any language (random letters, codes).
    """
    filters = language.learn_filters(docs.filter(~is_held_out("doc_id", 3, 1)))
    return language.keep_known(docs, filters, least=LEAST_SCORE)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each near-duplicate component."""
    return near_duplicates.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontaminate.without_passages(docs, table(spark, sf_dir, "benchmark"))


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret and ``n_chars`` counted anew."""
    clean = secret_scan.redact(docs, secret_scan.learn_formats(docs))
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in windows of 2048 tokens."""
    return queries.packed(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_redaction", secret_redaction),
    ("packing", packing),
]
ORACLE_SQL = None  # n-gram filters, SimHash, alignment, automata and packing are not SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to the documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
