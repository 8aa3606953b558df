from __future__ import annotations

import itertools
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from peneira.llm import sharding


def brute_cost(supply, capacity) -> int:
    """With unit costs, what a shard holds beyond its capacity has to move, and nothing else."""
    return sum(max(0, s - c) for s, c in itertools.zip_longest(supply, capacity, fillvalue=0))


def test_cheapest_flow():
    dice = random.Random(6)
    for _ in range(60):
        supply = [dice.randint(0, 40) for _ in range(dice.randint(1, 6))]
        m = dice.randint(1, 6)
        capacity = [sum(supply) // m + (j < sum(supply) % m) for j in range(m)]
        flow = sharding.cheapest_flow(supply, capacity, lambda i, j: int(i != j))
        for i, s in enumerate(supply):
            assert sum(n for (a, _), n in flow.items() if a == i) == s
        for j, c in enumerate(capacity):
            assert sum(n for (_, b), n in flow.items() if b == j) == c
        assert sum(n for (i, j), n in flow.items() if i != j) == brute_cost(supply, capacity)
    with pytest.raises(ValueError):
        sharding.cheapest_flow([1], [2], lambda i, j: 0)


def test_cheapest_flow_with_other_costs():
    cost = [[4, 1, 9], [2, 8, 3], [5, 5, 1]]
    flow = sharding.cheapest_flow([1, 1, 1], [1, 1, 1], lambda i, j: cost[i][j])
    best = min(sum(cost[i][p[i]] for i in range(3)) for p in itertools.permutations(range(3)))
    assert sum(cost[i][j] * n for (i, j), n in flow.items()) == best


def test_reshard(documents, clashing, no_documents, rows):
    by_source = F.when(F.col("source") == "hot", 1).otherwise(F.length("source") % 3)
    raw = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    columns = ("doc_id", F.octet_length(raw).alias("bytes"), F.crc32(raw).alias("crc"))
    found = sharding.reshard(clashing, by_source, 4, columns=columns).collect()
    got = Counter((r.doc_id, r.bytes, r.crc) for r in found)
    assert got == Counter((i, len((t or "").encode()), zlib.crc32((t or "").encode())) for i, t in rows)
    slots, sizes = defaultdict(list), Counter()
    for r in found:
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.bytes + 8
    assert set(slots) <= {0, 1, 2, 3}
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(len((t or "").encode()) for _, t in rows) + 8
    assert max(sizes.values()) - min(sizes.values()) <= 2 * largest
    assert sharding.reshard(no_documents, by_source, 4).count() == 0


def test_few_bytes_move_and_shards_are_even(spark):
    dice = random.Random(7)
    table = [(i, "x" * dice.randint(1, 400), 0 if dice.random() < 0.4 else dice.randrange(6)) for i in range(4000)]
    docs = spark.createDataFrame(table, "doc_id bigint, text string, place int").repartition(5)
    rows = sharding.sized(docs, "doc_id", "text", F.col("place"))
    plan = sharding.plan_equal_bytes(rows, 6)
    placed = plan.assign(rows).select("doc_id", "size", "old", "shard").collect()
    assert len(placed) == 4000
    sizes, moved, old = Counter(), 0, Counter()
    for r in placed:
        sizes[r.shard] += r.size
        old[r.old] += r.size
        moved += r.size * (r.old != r.shard)
    assert max(sizes.values()) - min(sizes.values()) < 0.01 * max(sizes.values())
    least = brute_cost([old[k] for k in range(6)], plan.bytes)
    assert abs(moved - least) < 0.01 * sum(sizes.values())
    assert 0 in plan.affected


def test_shards_that_are_even_stay(spark):
    docs = spark.range(4).select(F.col("id").alias("doc_id"), F.lit("same").alias("text"))
    plan = sharding.plan_equal_bytes(sharding.sized(docs, "doc_id", "text", F.col("doc_id")), 4)
    assert plan.affected == [] and set(plan.transfers) == {(i, i) for i in range(4)}


def test_old_shards_beyond_the_new_are_emptied(spark):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("same").alias("text"))
    rows = sharding.sized(docs, "doc_id", "text", F.col("doc_id") % 5)
    counts = {r.shard: r["count"] for r in sharding.plan_equal_bytes(rows, 2).assign(rows).groupBy("shard").count().collect()}
    assert set(counts) == {0, 1} and abs(counts[0] - counts[1]) <= 4


def test_equal_texts_stay_together_unless_no_room_holds_them(spark):
    dice = random.Random(8)
    table = [(i, f"{dice.random()} " * dice.randint(1, 6)) for i in range(3000)]
    table += [(3000 + 40 * g + i, f"group {g} " * 12) for g in range(30) for i in range(40)]
    table += [(9000 + i, "hot " * 30) for i in range(2500)]  # a third of all bytes and more: larger than any shard
    docs = spark.createDataFrame(table, "doc_id bigint, text string").repartition(7)
    columns = ("doc_id", F.octet_length("text").alias("bytes"), F.col("text_crc32"))
    found = sharding.reshard(docs, F.pmod(F.crc32(F.col("text").cast("binary")), F.lit(5)), 6, columns=columns).collect()
    assert sorted(r.doc_id for r in found) == sorted(i for i, _ in table)
    shards, sizes = defaultdict(set), Counter()
    for r in found:
        shards[r.text_crc32].add(r.shard)
        sizes[r.shard] += r.bytes + 8
    hot = zlib.crc32(("hot " * 30).encode())
    assert [c for c, s in shards.items() if len(s) > 1] == [hot]
    assert set(sizes) == set(range(6))
    assert max(sizes.values()) - min(sizes.values()) < 0.02 * max(sizes.values())


def test_only_files_that_a_transfer_cuts_are_written_anew(spark):
    dice = random.Random(9)
    table = [(i, f"{dice.random()} " * dice.randint(1, 9), i % 2 if i < 1500 else i % 4) for i in range(4000)]
    docs = spark.createDataFrame(table, "doc_id bigint, text string, place int").repartition(4)
    layout = sharding.reshard_files(docs, F.col("place"), 4)
    assert len(layout.kept) > 3 * len(layout.cut) > 0
    assert any(old != shard for old, _, shard in layout.kept)  # handed over whole
    old = spark.read.parquet(layout.old_path).select("doc_id", "old", "slice")
    new = spark.read.parquet(layout.new_path).select("doc_id", "old", "slice")
    cut = {(r.old, r.slice) for r in old.join(new.select("doc_id"), "doc_id").select("old", "slice").distinct().collect()}
    assert cut == set(layout.cut)
    assert new.count() == sum((r.old, r.slice) in cut for r in old.collect())
    found = layout.read(spark, ["doc_id", "text"]).collect()
    assert Counter((r.doc_id, r.text) for r in found) == Counter((i, t) for i, t, _ in table)
    even = sharding.reshard_files(docs.filter("doc_id < 4").withColumn("text", F.lit("same")), F.col("doc_id"), 4)
    assert even.cut == [] and {(a, c) for a, _, c in even.kept} == {(i, i) for i in range(4)}
    assert sorted(r.doc_id for r in even.read(spark, ["doc_id"]).collect()) == [0, 1, 2, 3]
