"""Connected components of a graph given by its links, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peneira.llm.common import stored


def _larger_to_least(links: DataFrame) -> DataFrame:
    """Links every node's larger neighbours to the least node around it."""
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("least"))
    return (
        both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()
    )


def _smaller_to_least(links: DataFrame) -> DataFrame:
    """Links every node and its smaller neighbours to the least of them (u > v in each link)."""
    least = links.groupBy("u").agg(F.min("v").alias("least"))
    moved = links.join(least, "u").filter("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.union(least.select("u", F.col("least").alias("v"))).distinct()


def least_reachable(links: DataFrame) -> DataFrame:
    """Nodes that have a link, with the least node they are connected to.

    ``links`` has two columns of numbers; direction, repeats and links of a node
    with itself do not matter. Result: ``node``, ``least``; the least node of a
    component is left out unless it is needed by the caller (it maps to itself).
    Alternates two steps that re-link neighbours to smaller nodes until every
    link joins a node to the least of its component; the number of rounds grows
    with the logarithm of the nodes. Every round is written to the shared
    folder, so that a lost executor costs no earlier round. Sums per node are
    taken before the shuffle, and a node with many links is a skewed join key,
    which adaptive execution splits.
    """
    a, b = links.columns
    now = links.filter(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(F.col(a), F.col(b)).alias("v")
    )
    now, before = stored(now.distinct(), "links"), None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("least"))
        before = state
        now = stored(_smaller_to_least(_larger_to_least(now)), "links")
