"""Putting several DataFrames together."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from peneira.functions.names import named
from peneira.workspace import new_folder

BROADCAST_KEYS = 100_000
BROADCAST_CHARS = 50_000_000
SALTS = 32  # tasks among which a frequent key is joined where frequent keys are too many to broadcast
COUNTERS = 98_000  # of the sketch of frequent keys
TABLE = 1 << 17  # places of the sketch's table, of which so many counters fill three quarters


def flatten(parts: Sequence[DataFrame]) -> DataFrame:
    """All rows of all parts, duplicates kept, matched by column name; no shuffle."""
    return functools.reduce(DataFrame.unionByName, parts)


def tagged_rows(df: DataFrame, key: str, inputs: Mapping[str, tuple[Column, Column | str]]) -> DataFrame:
    """The inputs of a co-group that come from one DataFrame, in one scan: ``key``, ``value``, ``tag``.

    ``inputs`` has a condition and a value for each tag; a row goes to every tag whose condition it meets.
    """
    of = lambda c: named(c) if isinstance(c, str) else c
    own = [
        F.when(condition, F.struct(of(value).alias("value"), F.lit(tag).alias("tag")))
        for tag, (condition, value) in inputs.items()
    ]
    met = F.filter(F.array(*own), lambda entry: entry.isNotNull())
    rows = df.select(named(key).alias("key"), F.explode(met).alias("entry"))
    return rows.select("key", "entry.value", "entry.tag")


def align(inputs: Mapping[str, DataFrame]) -> DataFrame:
    """Aggregates by the same key side by side: a row per key, a column per tag, null where an input lacks the key.

    For inputs with at most one row a key, as a ``groupBy`` gives them; a second one is an error. No lists are made.
    """
    tagged = flatten([df.select("key", "value", F.lit(tag).alias("tag")) for tag, df in inputs.items()])
    mine = lambda tag: F.when(F.col("tag") == tag, F.struct("value"))
    columns = [F.max(mine(tag)).alias(tag) for tag in inputs]
    most = F.greatest(*[F.count(mine(tag)) for tag in inputs], F.lit(0)).alias("most")
    grouped = tagged.groupBy("key").agg(*columns, most)
    once = F.when(F.col("most") > 1, F.raise_error(F.lit("align: a key has several values"))).otherwise(F.lit(True))
    return grouped.filter(once).select("key", *[F.col(tag)["value"].alias(tag) for tag in inputs])


def co_group(
    inputs: Mapping[str, DataFrame] | DataFrame,
    block_size: int,
    spread_by: Column | None = None,
    tags: Sequence[str] = (),
) -> DataFrame:
    """Bring the values of several ``key``/``value`` DataFrames together by key.

    The result has a row for every key *and block*, with a sorted array column per tag, empty
    where that block has none of the input's values. ``block`` counts from 0; a key with at
    most ``block_size`` values under each tag has block 0 alone. A frequent key is laid out over
    several blocks of about that size: no value is dropped, yet no task has to hold its whole
    list. Go on by (``key``, ``block``); to summarise rather than list the values, use
    ``summary_per_key``, and ``align`` for inputs that are aggregates by the key already.

    ``inputs`` may also be the result of ``tagged_rows``, which reads a shared source once; give its ``tags``.
    ``spread_by``, an integer expression of ``value``, says which block takes a value; the
    default is a hash. Equal values are counted before the shuffle, and a value repeated more
    than ``block_size`` times goes over several blocks too.

    The inputs are computed once, when this is called: their rows are stored in the shared folder, and the
    same pass keeps a sketch of the most frequent keys (a bounded number of counters in each task, merged
    on the driver). Only keys that the sketch cannot rule out are counted exactly, from the
    stored rows; where there are none, the values go through a single shuffle.
    """
    if isinstance(inputs, DataFrame):
        if not tags:
            raise ValueError("name the tags of the rows")
        tagged = inputs
    else:
        tags = list(inputs)
        tagged = flatten([df.select("key", "value", F.lit(tag).alias("tag")) for tag, df in inputs.items()])
    tagged, suspects = _stored_with_sketch(tagged, block_size)
    placed = _in_blocks(tagged, suspects, block_size, spread_by)
    if placed is None:
        placed = tagged.withColumns({"times": F.lit(1), "block": F.lit(0).cast("long")})
    run = F.struct("value", "times")
    lists = [F.array_sort(F.collect_list(F.when(F.col("tag") == tag, run))).alias(tag) for tag in tags]
    grouped = placed.groupBy("key", "block").agg(*lists)
    return grouped.select("key", "block", *[_expanded(tag).alias(tag) for tag in tags])


def _key_hash() -> Column:
    return F.xxhash64("key", "tag")


def _stored_with_sketch(tagged: DataFrame, block_size: int) -> tuple[DataFrame, list[int] | None]:
    """The rows, stored, and hashes of the keys that may have more than ``block_size`` values under a tag.

    The sketch holds ``COUNTERS`` counts and is wrong by at most 3.5 / 2 ** 17 of all rows (the table of
    2 ** 17 that so many need). It leaves out only keys whose count is at most twice that error. If a block takes
    fewer values than that, the sketch cannot rule out any key, and neither can it if it is full: None.
    """
    spark = tagged.sparkSession
    folder, seen = new_folder(spark, "tagged"), Observation()
    sketch = F.expr(f"approx_top_k(xxhash64(key, tag), {COUNTERS}, {COUNTERS})")
    tagged.observe(seen, F.count("*").alias("n"), sketch.alias("top")).write.parquet(folder)
    stored = spark.read.schema(tagged.schema).parquet(folder)
    n, top = seen.get["n"], seen.get["top"] or []
    if 2 * n * 3.5 / TABLE > block_size or len(top) >= COUNTERS:
        return stored, None
    return stored, [x.item for x in top if x["count"] > block_size]


def _frequent_keys(tagged: DataFrame, suspects: list[int] | None, block_size: int) -> DataFrame:
    """Keys with more values than a block takes, and how many blocks they need."""
    spark, rows = tagged.sparkSession, tagged.select("key", "tag")
    if suspects is not None:
        named_ones = spark.createDataFrame([(h,) for h in suspects], "hash long")
        rows = rows.join(F.broadcast(named_ones), _key_hash() == F.col("hash"), "left_semi")
    counts = rows.groupBy("key", "tag").agg(F.count("*").alias("n")).filter(F.col("n") > block_size)
    frequent = counts.groupBy(F.col("key").alias("frequent_key")).agg(
        F.ceil(F.max("n") / block_size).alias("blocks")
    )
    folder = new_folder(spark, "frequent-keys")
    frequent.write.parquet(folder)
    return spark.read.schema(frequent.schema).parquet(folder)


def _runs(tagged: DataFrame, block_size: int) -> DataFrame:
    """Equal values of a key and tag as counted runs of at most ``block_size``."""
    counted = tagged.groupBy("key", "tag", "value").agg(F.count("*").alias("n"))
    last = F.floor((F.col("n") - 1) / block_size)
    return counted.select("*", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("run")).select(
        "key",
        "tag",
        "value",
        "run",
        F.least(F.lit(block_size), F.col("n") - F.col("run") * block_size).cast("int").alias("times"),
    )


def _in_blocks(
    tagged: DataFrame, suspects: list[int] | None, block_size: int, spread_by: Column | None
) -> DataFrame | None:
    """Counted runs of equal values and their block; None if every key fits one."""
    if suspects == []:
        return None
    frequent = _frequent_keys(tagged, suspects, block_size)
    size = frequent.agg(
        F.count("*").alias("keys"),
        F.coalesce(F.sum(F.length(F.col("frequent_key").cast("string"))), F.lit(0)).alias("chars"),
    ).first()
    if size["keys"] == 0:
        return None
    runs, same = _runs(tagged, block_size), F.col("key").eqNullSafe(F.col("frequent_key"))
    if size["keys"] <= BROADCAST_KEYS and size["chars"] <= BROADCAST_CHARS:
        joined = runs.join(F.broadcast(frequent), same, "left")
    else:
        # A frequent key's runs go to SALTS tasks for the join, and the few rows of frequent keys to each of them.
        salt = F.pmod(F.xxhash64("value", "run"), F.lit(SALTS))
        copies = frequent.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("copy"))
        joined = runs.withColumn("salt", salt).join(copies, same & (F.col("salt") == F.col("copy")), "left")
    place = F.xxhash64("value") if spread_by is None else F.coalesce(spread_by, F.lit(0))
    blocks = F.coalesce(F.col("blocks"), F.lit(1))
    # Modulo first: adding the run to a 64-bit hash could overflow.
    block = F.pmod(F.pmod(place, blocks) + F.col("run"), blocks).cast("long")
    return joined.withColumn("block", block).select("key", "tag", "value", "times", "block")


def _expanded(tag: str) -> Column:
    return F.flatten(F.transform(F.col(tag), lambda run: F.array_repeat(run["value"], run["times"])))
