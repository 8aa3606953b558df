"""The registered queries of this subpackage, each with its SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peneira.llm import (
    decontaminate,
    language,
    near_duplicates,
    neighbours,
    ngram_trie,
    packing,
    periodic_runs,
    quality,
    ranked_search,
    secret_scan,
    sharding,
    token_codes,
    url_filter,
)
from peneira.llm.common import is_held_out
from peneira.plans.inputs import table

MANY_UNITS = 400_000  # where tokenising is all that a worker does, it may keep more


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from two thirds of those that name one."""
    docs = table(spark, sf_dir, "documents")
    held_out = is_held_out("doc_id", 3, 1)
    filters = language.learn_filters(docs.filter(~held_out))
    found = language.identify(docs, filters, keep=["doc_id"])
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality and decency scores of every document."""
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


def op3_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place and digest of every document in files of directly addressable codes."""
    docs = table(spark, sf_dir, "documents")
    file = public_tokenizers.path("byte_bpe_50k.json")
    return token_codes.coded(docs, file, 2, digest=token_codes.crc32_of, known_units=MANY_UNITS).withColumnRenamed("digest", "ids_crc32")


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth, by inner product."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 20 == 0)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into windows of 2048 tokens."""
    docs = table(spark, sf_dir, "documents")
    return packed(docs, known_units=MANY_UNITS)


def packed(docs: DataFrame, **how) -> DataFrame:
    """The pieces of documents with digests of their ids."""
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), 1, **how)
    digest = F.crc32("ids").alias("ids_crc32")
    return pieces.select("doc_id", "start", "length", digest, "doc_tokens", "sequence_id", "offset")


def op6_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of every document under a bigram trie of six sevenths of them."""
    return ngram_trie.score(table(spark, sf_dir, "documents"), is_held_out("doc_id", 7, 2))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: those of the fixed patterns and those of learned formats."""
    docs = table(spark, sf_dir, "documents")
    found = secret_scan.scan(docs, secret_scan.learn_formats(docs))

    def of(*kinds: str):
        return F.filter("spans", lambda s: s.kind.isin(*kinds))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")

    base = secret_scan.KINDS[:3]
    return found.select(
        "doc_id",
        *(F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in base),
        F.sha2(listed(of(*base)).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        F.array_join(F.transform("scores", lambda s: F.concat_ws(":", s.likely, F.format_string("%.3f", s.bits))), ",").alias("likely"),
    )


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 24 shards of equal bytes, moved from 20 shards by hash of the text."""
    docs = table(spark, sf_dir, "documents")
    raw = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    by_text = F.pmod(F.crc32(raw), F.lit(20)).cast("int")
    size = (F.octet_length(raw) + 8).cast("long").alias("size")
    placed = sharding.reshard(docs, by_text, 24, columns=("doc_id", size, F.crc32(raw).alias("text_crc32")))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in the documents, with their places."""
    return decontaminate.passages_in(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents for each benchmark item."""
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``, in which a tenth of the documents repeat some words up to their end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("words"))
    rows = rows.withColumn("n", F.size("words"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    rows = rows.withColumn("p", F.expr("CAST(1 + (n - a) DIV (3 + g % 8) AS INT)"))
    again = F.expr("slice(flatten(array_repeat(slice(words, a + 1, p), CAST((n - a) DIV p + 1 AS INT))), 1, n - a)")
    planted = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), again), " ")
    return rows.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest run of every document, and digests of all runs and of the text without their repeats."""
    found = periodic_runs.find_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    ranked = F.transform("runs", lambda r: F.struct(r.length.alias("l"), (-r.start).alias("s"), (-r.period).alias("p")))
    line = lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))
    rows = found.select("*", F.array_max(ranked).alias("best"))
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.l").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.expr("(1000 * best.l) DIV (-best.p)").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule that fits each page's URL, and its verdict."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules)


QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_quality,
        op3_token_codes,
        op4_nearest,
        op5_packing,
        op6_lm_scores,
        op7_secrets,
        op8_simhash,
        op9_shards,
        op10_decontamination,
        op11_ranked_search,
        op12_periodic_runs,
        op13_url_filter,
    )
}
ORACLE_SQL: dict[str, str] = {
    "op4_nearest": """WITH usable AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.v, c.v) AS score
  FROM usable AS q JOIN usable AS c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 20""",
    "op11_ranked_search": r"""WITH d AS (
  SELECT row_number() OVER () AS row, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
i AS (
  SELECT row_number() OVER () AS item, item_id,
    unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
sums AS (SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM d WHERE len(terms) > 0),
tf AS (
  SELECT row, doc_id, n, term, count(*) AS tf
  FROM (SELECT row, doc_id, len(terms) AS n, unnest(terms) AS term FROM d) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, sums GROUP BY term),
parts AS (
  SELECT row, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms))) AS part
  FROM tf JOIN weights USING (term), sums),
scored AS (
  SELECT item, item_id, row, doc_id, CAST(sum(part) AS BIGINT) AS score
  FROM i JOIN parts USING (term) GROUP BY ALL HAVING sum(part) > 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS place FROM scored)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 20""",
    "op13_url_filter": """WITH rules(h, p, verdict) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
tails AS (
  SELECT row_number() OVER () AS place, page_id,
    CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS tail FROM pages),
parts AS (
  SELECT place, page_id, regexp_extract(tail, '^[^/?#]*([^?#]*)', 1) AS path,
    translate(regexp_extract(tail, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host FROM tails)
SELECT page_id, host, path, h || p AS rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
QUALIFY row_number() OVER (PARTITION BY place ORDER BY length(h || p) DESC) = 1""",
}
