"""Ranked search against scoring every document for every item."""

from __future__ import annotations

import math
import re
from collections import Counter

import pytest
from compare import connect, duck_bag, spark_bag
from conftest import bag
from pyspark.sql import functions as F

from peneira.llm import queries, ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text: str | None) -> list[str]:
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, top: int = 20):
    bags = [(i, terms_of(t)) for i, t in docs]
    bags = [(i, Counter(t), len(t)) for i, t in bags if t]
    n_docs, n_terms = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, own, _ in bags for t in own)
    found = []
    for item, text in items:
        scored = []
        for i, own, n in bags:
            m = 100 - 25 + (25 * n * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * own[t]) // (1000 * own[t] + 12 * m))
                for t in terms_of(text)
                if t in own
            )
            if score > 0:
                scored.append((-score, i is None, i, score))
        ranked = sorted(scored, key=lambda x: x[:3] if x[2] is not None else (x[0], True, 0))[:top]
        found += [(item, k, i, score) for k, (_, _, i, score) in enumerate(ranked, 1)]
    return sorted(found, key=repr)


@pytest.fixture(scope="module")
def items(spark, rows):
    texts = [t for _, t in rows[:200:9]] + [None, "", "--- ?", "Zzz unheard-of", "THE of the the ÉTÉ 日本語 🙂", rows[194][1]]
    table = [(k, t, "x") for k, t in enumerate(texts)] + [(None, texts[0], "y"), (3, texts[3], "z")]
    return spark.createDataFrame(table, "item_id long, text string, rank string")


@pytest.mark.parametrize(("block_terms", "top"), [(500_000, 20), (60, 3)])
def test_search_ranks_as_scoring_everything(documents, rows, items, block_terms, top):
    asked = [(r.item_id, r.text) for r in items.collect()]
    found = ranked_search.search(documents, items, top=top, block_terms=block_terms)
    assert found.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert bag(found) == brute(rows, asked, top)


def test_other_columns_ids_and_empty_tables(clashing, documents, rows, no_documents, items):
    few = items.filter("item_id < 3")
    wanted = bag(ranked_search.search(documents, few))
    assert bag(ranked_search.search(clashing, few)) == wanted
    assert ranked_search.search(no_documents, items).count() == 0
    assert ranked_search.search(documents, items.limit(0)).count() == 0
    named = documents.withColumn("doc_id", F.col("doc_id").cast("string"))
    assert ranked_search.search(named, few).schema["doc_id"].dataType.simpleString() == "string"


def test_copies_are_one_class(spark):
    docs = spark.createDataFrame([(i, f"alpha beta {'x' if i % 2 else 'y'}") for i in range(400)] + [(500, "beta alpha z z")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "alpha beta")], "item_id long, text string")
    bags = ranked_search._bags(docs, "doc_id", "text", [b"alpha", b"beta"])
    classes = ranked_search.classes_of(bags, 401, 1204).collect()
    assert sorted(len(c.members) for c in classes) == [1, 20]
    assert [r.doc_id for r in ranked_search.search(docs, items).orderBy("rank").collect()] == list(range(20))


def test_items_of_very_many_terms_are_exact(spark):
    texts = [f"w{k} " * (k + 1) + "u" for k in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    long = " ".join(f"w{k % 40} u" for k in range(1_500_000))
    items = spark.createDataFrame([(1, long)], "item_id long, text string")
    n = Counter(terms_of(long))
    scorer_total = brute(list(enumerate(texts)), [(1, "w39 u")], 1)[0][3]
    assert scorer_total * max(n.values()) > 2**40
    wanted = brute(list(enumerate(texts)), [(1, " ".join(f"w{k} u" for k in range(40)))])
    by_doc = {d: s for _, _, d, s in wanted}
    found = {r.doc_id: r.score for r in ranked_search.search(docs, items).collect()}
    assert found == {d: s * (1_500_000 // 40) for d, s in by_doc.items()}


def test_the_query_agrees_with_sql(spark, sf_dir):
    columns, found = spark_bag(queries.QUERIES["op11_ranked_search"](spark, sf_dir))
    assert (columns, found) == duck_bag(connect(sf_dir), queries.ORACLE_SQL["op11_ranked_search"])
    assert sum(found.values()) > 500
