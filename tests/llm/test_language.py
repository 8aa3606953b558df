from __future__ import annotations

import numpy as np
from conftest import bag
from pyspark.sql import functions as F

from peneira.llm import language, queries


def test_grams_stay_within_words_and_texts():
    grams, owner, letters = language.trigrams(["Ab c", "", "1!", "é"])
    text = ["".join(chr(int(g) >> s & 0x1FFFFF) for s in (42, 21, 0)) for g in grams]
    assert list(zip(text, owner.tolist())) == [(" ab", 0), ("ab ", 0), ("b c", 0), (" c ", 0), (" é ", 3)]
    assert letters.tolist() == [True, False, False, True]


def test_counts_are_those_of_all_texts(spark, documents):
    counted = {(r.lang, r.gram): r.n for r in language.gram_counts(documents, "text", "lang").collect()}
    wanted: dict = {}
    for r in documents.filter("lang is not null").collect():
        for gram in language.trigrams([r.text or ""])[0].view(np.int64).tolist():
            wanted[r.lang, gram] = wanted.get((r.lang, gram), 0) + 1
    assert counted == wanted


def test_filters_hold_what_was_put_in(documents):
    filters = language.learn_filters(documents, rare=1e-4)
    assert filters.languages == ["en", "fr"]
    for k, lang in enumerate(filters.languages):
        text = documents.filter((F.col("lang") == lang) & (F.length("text") > 100)).first().text
        grams = language.trigrams([text])[0]
        assert ((filters.masks(grams)[:, 0] >> np.uint64(k)) & np.uint64(1)).mean() > 0.95
    other = np.arange(1, 20_000, dtype=np.uint64) << np.uint64(45)
    seen = (filters.masks(other)[:, 0][:, None] >> np.arange(2, dtype=np.uint64)) & np.uint64(1)
    assert np.abs(seen.mean(axis=0) - filters.false_rate).max() < 0.01


def test_prediction(documents, clashing):
    filters = language.learn_filters(documents)
    found = language.identify(documents, filters)
    joined = documents.filter("lang is not null and length(text) > 40").join(found, "doc_id")
    assert joined.filter("lang = lang_pred").count() / joined.count() > 0.97
    odd = {r.doc_id: (r.lang_pred, r.score) for r in found.filter("doc_id in (190, 191, 192, 193)").collect()}
    assert set(odd.values()) == {("und", 0.0)} and len(odd) == 4
    assert found.count() == documents.count()
    assert found.filter("score < 0 or score > 1 or score is null").count() == 0
    assert bag(language.identify(clashing, filters)) == bag(found)
    kept = language.keep_known(documents, filters)
    assert kept.columns == documents.columns
    assert {190, 191, 192, 193}.isdisjoint(r.doc_id for r in kept.collect())


def test_nothing_to_learn_from(documents, no_documents):
    filters = language.learn_filters(no_documents)
    assert {tuple(r) for r in language.identify(documents, filters).select("lang_pred", "score").collect()} == {("und", 0.0)}
    assert language.identify(no_documents, filters).count() == 0


def test_held_out_accuracy(spark, sf_dir):
    found = queries.op1_language_id(spark, sf_dir).filter("held_out")
    truth = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    assert found.join(truth, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.98
