from __future__ import annotations

from conftest import bag
from plan import physical
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from peneira.llm import language, near_duplicates, queries


def test_registered():
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in queries.QUERIES}
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry_points.queries())
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "near_dedup", "decontamination", "secret_redaction", "packing",
    ]
    assert corpus_pipeline.ORACLE_SQL is None


def test_near_dedup_broadcasts_no_exploded_rows(spark, documents, sf_dir, monkeypatch):
    links = []
    found = near_duplicates.least_reachable
    monkeypatch.setattr(near_duplicates, "least_reachable", lambda df: links.append(df) or found(df))
    corpus_pipeline.near_dedup(spark, documents, sf_dir)
    assert len(links) == 1 and "SortMergeJoin" in physical(links[0]) and "Broadcast" not in physical(links[0])


def test_every_stage_takes_odd_rows_and_gives_the_columns_of_documents(spark, documents, no_documents, clashing, sf_dir):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, documents, sf_dir)
        assert kept.columns == documents.columns
        assert 0 < kept.count() <= documents.count(), name
        assert stage(spark, no_documents, sf_dir).count() == 0
        assert stage(spark, clashing, sf_dir).columns == clashing.columns
    assert corpus_pipeline.packing(spark, documents, sf_dir).select("doc_id").distinct().count() == documents.select("doc_id").distinct().count()
    assert corpus_pipeline.packing(spark, no_documents, sf_dir).count() == 0


def test_the_whole_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    pieces = corpus_pipeline.run(spark, sf_dir)
    packed = {r.doc_id for r in pieces.select("doc_id").distinct().collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    clean = {i for i, t in texts.items() if not any(item in t for item in items)}
    first = {r.doc_id for r in near_duplicates.near_duplicates(docs).filter("doc_id = component_id").collect()}
    filters = language.learn_filters(docs.filter(~F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))))
    known = {r.doc_id for r in language.keep_known(docs, filters).collect()}
    assert packed == clean & first & known
    assert pieces.filter("length < 1 or offset < 0 or offset + length > 2048").count() == 0


def test_written_digests_are_unsigned(spark, sf_dir):
    for name, column in (("op3_token_codes", "ids_crc32"), ("op9_shards", "text_crc32")):
        low, high = queries.QUERIES[name](spark, "/root/testdata/sf0.001").agg(F.min(column), F.max(column)).first()
        assert 0 <= low <= high < 2**32 and high > 2**31


def test_results_do_not_depend_on_how_rows_are_dealt(documents):
    again = documents.repartition(7, "n_chars")
    assert bag(near_duplicates.near_duplicates(again)) == bag(near_duplicates.near_duplicates(documents))
