"""Rules on URLs against a brute-force look-up, and cascades against sets."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from compare import connect, duck_bag, spark_bag
from conftest import bag
from pyspark.sql import functions as F

from peneira.llm import queries, url_filter

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]
ODD = [
    None, "", "example.com/en/", "://", "http://", "http://COM/", "http://com", "http://com?x=/", "http://xcom/", "http://.com/",
    "http://a.com/", "http://www.Example.com/en/a?b#c", "http://x.www.example.com/en/", "http://wwww.example.com/en/",
    "http://example.com/EN/", "http://example.com/en", "https://net/es/", "https://a.net/fr/#x", "ftp://b.net/de/://com/", "http://example.com:80/en/",
    "http://é.example.com/en/ü", "http://a.net#/es/", "x\n://a.com/\n", "http://a.com/" + "y" * 100_000, "http://" + "a." * 20_000 + "com/en/",
]


def brute(url: str | None, rules) -> tuple[str, str, str | None, str]:
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", rest).groups()
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [
        (len(h) + len(p), len(h), v == "block", h + p, v)
        for h, p, v in rules
        if h is not None and p is not None and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=None)
    return (host, path, best[3], best[4]) if best else (host, path, None, "allow")


@pytest.fixture(scope="module")
def pages(spark):
    dice = random.Random(3)
    urls = list(ODD)
    for _ in range(400):
        host = ".".join(dice.choice(["a", "b", "www", "example", "net", "com", ""]) for _ in range(dice.randint(1, 4)))
        urls.append(f"http://{host}" + "".join(dice.choice(["/en", "/es", "/fr/", "/", "x"]) for _ in range(dice.randint(0, 3))))
    rows = [(i // 2, u, "r", "h") for i, u in enumerate(urls + urls[:20])] + [(None, "http://a.com/", None, None)]
    return spark.createDataFrame(rows, "page_id long, url string, rule string, host string")


@pytest.mark.parametrize("block_keys", [10_000, 4])
def test_judged_as_by_looking_at_every_rule(spark, pages, block_keys):
    dice = random.Random(4)
    rules = list(RULES) + [("", "", "block"), ("b.COM", "", "block"), (None, "/", "block"), ("com", None, "allow"), ("a/b", "/", "block"), ("com", "x", "block")]
    for _ in range(25):
        rules.append((dice.choice(["a.com", "b.net", "com", "www.com", "example.net"]), dice.choice(["", "/", "/en", "/en/es", "/fr/x"]), dice.choice(["allow", "block"])))
    given = spark.createDataFrame(rules, "host string, path string, verdict string")
    usable = [(h and h.lower(), p, v) for h, p, v in rules if h is not None and "/" not in h]
    wanted = sorted(((r.page_id, *brute(r.url, usable)) for r in pages.collect()), key=repr)
    assert bag(url_filter.judge(pages, given, block_keys=block_keys)) == wanted


def test_no_rules_no_pages(spark, pages):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    assert url_filter.judge(pages.limit(0), rules).count() == 0
    found = url_filter.judge(pages, rules.limit(0))
    assert found.count() == pages.count() and found.filter("rule IS NOT NULL OR verdict <> 'allow'").count() == 0
    with pytest.raises(Exception, match="allow or block"):
        url_filter.judge(pages, rules.withColumn("verdict", F.lit("maybe")))


@pytest.mark.parametrize(("listed", "others"), [(0, 100), (1, 5000), (700, 20_000), (500, 0), (3000, 300)])
def test_a_cascade_tells_every_key_of_its_universe(spark, listed, others):
    on = spark.range(listed).select(F.concat(F.lit("k"), "id").alias("key"))
    every = spark.range(listed // 2, listed + others).select(F.concat(F.lit("k"), "id").alias("key"))
    cascade = url_filter.build_cascade(on.union(on), every.union(every.limit(50)).union(spark.sql("SELECT CAST(NULL AS STRING) AS key")))
    rows = url_filter._hashed(every).toPandas()
    a, b = (rows[c].to_numpy().astype(np.int64).view(np.uint64) for c in "ab")
    assert url_filter.members(cascade, a, b).tolist() == [int(k[1:]) < listed for k in rows.key]
    bits = sum(64 * len(words) for words, _ in cascade)
    if listed > 100 and others:
        assert bits < listed * (1.44 * max(0, np.log2((listed + others) / listed)) + 8) + 128 * len(cascade)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01", "/root/testdata/sf0.001"])
def test_the_query_agrees_with_sql(spark, folder):
    columns, found = spark_bag(queries.QUERIES["op13_url_filter"](spark, folder))
    assert (columns, found) == duck_bag(connect(folder), queries.ORACLE_SQL["op13_url_filter"])
    assert len(found) >= 50
