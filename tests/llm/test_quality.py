from __future__ import annotations

import random

import numpy as np
import pytest
from conftest import bag, sentence
from pyspark.sql import functions as F

from peneira.llm import quality


def test_estimation_finds_accuracies():
    dice = random.Random(16)
    right = ((0.8, 0.97), (0.6, 0.99), (0.7, 0.95), (0.5, 0.98))
    counts: dict = {}
    truth: dict = {}
    for _ in range(20_000):
        good = dice.random() < 0.85
        votes = tuple(
            0 if dice.random() < 0.2 else (1 if good else -1) * (1 if dice.random() < right[k][good] else -1) for k in range(4)
        )
        counts[votes] = counts.get(votes, 0) + 1
        truth[votes] = truth.get(votes, 0) + good
    patterns = sorted(counts.items())
    chance, accuracy, share = quality.estimate(patterns)
    assert abs(share - 0.85) < 0.03
    assert np.abs(accuracy[1] - [r[1] for r in right]).max() < 0.02
    assert np.abs(accuracy[0] - [r[0] for r in right]).max() < 0.08
    for (votes, n), p in zip(patterns, chance, strict=True):
        if n > 300:
            assert abs(p - truth[votes] / n) < 0.1


def test_features_of_odd_texts():
    assert len(quality.features("", {})[0]) == 0
    slots, values = quality.features("Word word word, 12", {})
    assert len(set(slots.tolist())) == len(slots) and (values <= 1).all() and (values > 0).all()


def test_scorer_fits_a_rule():
    dice = random.Random(17)
    texts = [sentence(dice, "en", 40) + (" dreadful" if i % 5 == 0 else "") for i in range(600)]
    target = np.array([0.05 if i % 5 == 0 else 0.97 for i in range(600)])
    weights, offset = quality.fit([quality.features(t, {}) for t in texts], target)
    for text, good in ((sentence(dice, "en", 60), True), (sentence(dice, "en", 30) + " dreadful " + sentence(dice, "en", 30), False)):
        slots, values = quality.features(text, {})
        assert (weights[slots] @ values + offset > 0) == good
    assert quality.fit([], np.zeros(0))[1] == 0.0


@pytest.fixture(scope="module")
def scored(spark, documents):
    dice = random.Random(18)
    rows = [(1000 + i, sentence(dice, "en", 80) + ".", None, None, None) for i in range(300)]
    rows += [(2000 + i, " | ".join(sentence(dice, "en", 1) + "###" for _ in range(60)), None, None, None) for i in range(60)]
    rows += [(3000 + i, sentence(dice, "en", 60) + f" vile{i % 4} nasty{i % 3} awful " + sentence(dice, "en", 20), None, None, None) for i in range(60)]
    docs = documents.unionByName(spark.createDataFrame(rows, documents.schema))
    labels = docs.select("doc_id", F.lit(1).alias("quality"), (F.col("doc_id") >= 3000).cast("int").alias("toxic"))
    odd = spark.createDataFrame([(None, 1, 1), (1000, 1, None), (99_999, 0, 1), (1001, 1, 0)], "doc_id bigint, quality int, toxic int")
    return docs, quality.learn(docs, labels.union(odd))


def test_junk_and_unwanted_texts_are_told(scored):
    docs, scorers = scored
    assert {"awful", "nasty", "vile"} <= set(scorers.terms)
    found = {r.doc_id: r for r in quality.score(docs, scorers).filter("doc_id >= 1000").collect()}
    assert np.mean([found[i].keep for i in range(1000, 1300)]) > 0.97
    assert np.mean([found[i].quality < 0.5 for i in range(2000, 2060)]) > 0.95
    assert np.mean([found[i].decency < 0.5 for i in range(3000, 3060)]) > 0.9


def test_odd_rows(scored, documents, clashing, no_documents):
    _, scorers = scored
    found = quality.score(documents, scorers)
    rows = {r.doc_id: r for r in found.collect()}
    assert [(rows[i].quality, rows[i].keep) for i in (190, 191, 192)] == [(0.0, False)] * 3
    assert found.count() == documents.count()
    assert bag(quality.score(clashing, scorers)) == bag(found)
    assert quality.score(no_documents, scorers).count() == 0


def test_without_labels_or_documents(spark, documents, no_documents):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    scorers = quality.learn(documents, labels)
    assert scorers.terms == []
    assert quality.score(documents, scorers).filter("decency < 0.5").count() <= 4  # texts without a word
    empty = quality.learn(no_documents, labels)
    assert quality.score(no_documents, empty).count() == 0


def brute_learning(rows, terms):
    """Votes of every row by plain counting, and their good-row chances."""
    group = quality.quality_labellers()
    bounds = {
        "symbols": lambda m, n: (m["odd"] < 0.02, m["odd"] > 0.05),
        "capitals": lambda m, n: (m["capitals"] < 0.2, m["capitals"] > 0.5),
        "variety": lambda m, n: (n >= 30 and m["distinct"] > 0.45, n >= 30 and m["distinct"] < 0.3),
        "repeats": lambda m, n: (m["again"] < 0.05, n >= 30 and m["again"] > 0.2),
        "function_words": lambda m, n: (m["common"] > 0.12, n >= 30 and m["common"] < 0.04),
        "sentences": lambda m, n: (0.02 <= m["stops"] <= 0.35, n >= 30 and (m["stops"] < 0.005 or m["stops"] > 0.6)),
        "letters": lambda m, n: (m["letters"] > 0.72, m["letters"] < 0.6),
        "word_length": lambda m, n: (2.5 <= m["word_chars"] <= 9, m["word_chars"] < 1.5 or m["word_chars"] > 14),
    }
    counts, texts = {}, {}
    for i, text in rows:
        n, m, _ = quality.measures(text or "", {t: k % 3 for k, t in enumerate(terms)})
        pattern = tuple(1 if good else -1 if bad else 0 for good, bad in (bounds[x.name](m, n) for x in group))
        counts[pattern] = counts.get(pattern, 0) + 1
        texts[i, text or ""] = pattern
    patterns = sorted(counts.items())
    good, accuracy, _ = quality.estimate(patterns)
    return texts, dict(zip((p for p, _ in patterns), good, strict=True)), accuracy


def test_learning_equals_brute_force(spark, scored):
    docs, scorers = scored
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    texts, chance, accuracy = brute_learning(rows, scorers.terms)
    assert np.allclose(scorers.accuracies["quality"], accuracy)
    vectors, target = [], []
    for (_, text), pattern in sorted(texts.items(), key=repr):
        vectors.append(quality.features(text, {}))
        target.append(chance[pattern])
    weights, offset = quality.fit(vectors, np.array(target))
    found = {(r.doc_id, r.quality) for r in quality.score(docs, scorers).filter("doc_id >= 1000").collect()}
    brute = {}
    for i, text in rows:
        if i is not None and i >= 1000:
            slots, values = quality.features(text, {})
            brute[i] = 1 / (1 + np.exp(-(weights[slots] @ values + offset)))
    # null and empty text of one id apart, the same fit; sums are added in another order
    assert max(abs(q - brute[i]) for i, q in found) < 0.05


def test_rows_that_repeat_are_fitted_on_once(spark):
    dice = random.Random(19)
    rows = [(i, sentence(dice, "en", 30)) for i in range(300)] + [(7, "one row again and again")] * 6000 + [(None, "no id")] * 300
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    seen = quality.measured(docs, [], 1.0).filter("slots is not null")
    assert seen.count() <= 300 + 6 * 2 and seen.select("hash").distinct().count() == 302
    labels = spark.createDataFrame([(7, 1, 1), (7, 1, 0)], "doc_id bigint, quality int, toxic int")
    scorers = quality.learn(docs, labels, sample=50)
    assert quality.score(docs, scorers).count() == 6600
