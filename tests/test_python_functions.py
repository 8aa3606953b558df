"""Operators that take a Python function, and their native counterparts."""

from __future__ import annotations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from peneira.operators import python_functions as pf
from peneira.operators.projections import explode_tokens
from peneira.plans.inputs import table
from peneira.sources import inline_rows


def values(df) -> list:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_map_sees_python_values_and_nulls(spark):
    df = inline_rows(spark, [(1, "a"), (None, "b"), (2**53 + 1, None)], "i long, t string")
    got = df.select(pf.map_values(lambda i, t: f"{i!r}/{t!r}", "string", "i", "t"))
    assert values(got) == sorted([("1/'a'",), ("None/'b'",), (f"{2**53 + 1}/None",)], key=repr)


def test_map_equals_native(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    python = parts.select("p_partkey", pf.map_values(str.upper, "string", "p_name").alias("r"))
    assert values(python) == values(parts.select("p_partkey", F.upper("p_name").alias("r")))


def test_filter_nothing_counts_as_false(spark):
    df = inline_rows(spark, [("quatro",), ("um",), ("quatro.",), (None,)], "t string")

    def listed(word):
        if word in ("quatro", "um"):
            return True

    assert values(pf.keep_if(df, listed, "t")) == [("quatro",), ("um",)]


def test_pinned_filter_stays_above_the_aggregate(spark):
    from plan import physical

    counted = spark.range(100).groupBy((F.col("id") % 7).alias("k")).count()
    for pinned in (False, True):
        kept = pf.keep_if(counted, lambda k: k < 3, "k", pinned=pinned)
        assert values(kept) == [(0, 15), (1, 15), (2, 14)]
        plan = physical(kept)
        assert (plan.index("ArrowEvalPython") < plan.index("HashAggregate")) == pinned


def test_flat_map_equals_native(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    split = lambda text: [word for line in text.split("\n") for word in line.split(" ")]
    python = pf.flat_map(documents, split, "text", "token", "string")
    count = lambda df: values(df.groupBy("token").count())
    assert count(python) == count(explode_tokens(documents, "text"))


def test_records_by_name_and_position_zero_to_many(spark):
    df = inline_rows(spark, [(0, "a"), (1, "b"), (3, None)], "n int, t string")

    def process(record):
        assert record[0] == record.n
        if record.n:
            return [(record.t, i) for i in range(record.n)]
        return None

    assert values(pf.for_each_record(df, process, "t string, i int")) == sorted(
        [("b", 0), (None, 0), (None, 1), (None, 2)], key=repr
    )


def test_output_comes_in_bounded_batches():
    schema = pa.schema([("i", pa.int64())])
    batch = pa.RecordBatch.from_pydict({"n": [25_000, 0, 3]})
    sizes = [
        b.num_rows for b in pf._process_records(iter([batch]), lambda r: ((i,) for i in range(r.n)), schema)
    ]
    assert sizes == [10_000, 10_000, 5_003]


@pytest.mark.parametrize("held", [100_000, 3])
def test_combine_with_a_frequent_key(spark, monkeypatch, held):
    monkeypatch.setattr(pf, "HELD_KEYS", held)
    rows = spark.range(0, 60_000, 1, 12).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 500).cast("string")).alias("k"),
        F.col("id").alias("v"),
    )
    assert values(pf.combine_per_key(rows, "k", "v", sum)) == values(
        rows.groupBy("k").agg(F.sum("v").alias("v"))
    )
    assert values(pf.combine_per_key(rows, "k", "v", max)) == values(
        rows.groupBy("k").agg(F.max("v").alias("v"))
    )


def test_combine_holds_few_keys():
    batches = [pa.RecordBatch.from_pydict({"k": list(range(50)), "v": [1] * 50})] * 4
    small = pf.HELD_KEYS
    try:
        pf.HELD_KEYS = 20
        partial = [b.to_pylist() for b in pf._combine(iter(batches), sum, by_key=False)]
    finally:
        pf.HELD_KEYS = small
    assert sum(r["v"] for b in partial for r in b) == 200


def test_combine_keeps_null_keys_and_types(spark):
    rows = inline_rows(spark, [(None, 1), (None, 2), (5, 3), (5, 4)], "k int, v int")
    got = pf.combine_per_key(rows, "k", "v", sum)
    assert got.dtypes == [("k", "int"), ("v", "bigint")]
    assert values(got) == sorted([(None, 3), (5, 7)], key=repr)
    assert pf.combine_per_key(rows, "k", "v", max, "int").dtypes == [("k", "int"), ("v", "int")]


def test_combine_agrees_with_the_named_form(spark):
    nan = float("nan")
    big = [(nan, 2**31 - 1), (nan, 1), (0.0, 5), (-0.0, 6), (None, None), (None, 3), (2.0, None), (1.0, 2**31 - 1)]
    rows = inline_rows(spark, big, "k double, v int").repartition(5)
    for name, function in (("sum", sum), ("min", min), ("max", max)):
        got, wanted = pf.combine_per_key(rows, "k", "v", function), pf.combine_per_key(rows, "k", "v", name)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, wanted.collect()))


def test_combine_by_array_keys(spark):
    rows = inline_rows(spark, [(["a", "b"], 1), (["a", "b"], 2), (["c"], 4), (None, 8)], "k array<string>, v int")
    got = {tuple(r.k or ()): r.v for r in pf.combine_per_key(rows.repartition(4), "k", "v", sum).collect()}
    assert got == {("a", "b"): 3, ("c",): 4, (): 8}


def test_combine_bounds_what_it_holds_by_bytes():
    batches = [pa.RecordBatch.from_pydict({"k": [i], "v": ["x" * 1000]}) for i in range(10)]
    held = pf.HELD_BYTES
    try:
        pf.HELD_BYTES = 2000
        assert len(list(pf._combine(iter(batches), max, by_key=False))) > 3
    finally:
        pf.HELD_BYTES = held


def test_flat_map_gives_bounded_batches():
    kind = pa.schema([("i", pa.int64())])
    batch = pa.RecordBatch.from_pydict({"n": [25_000, 0, 3]})
    assert [b.num_rows for b in pf._flatten_items(iter([batch]), range, kind)] == [10_000, 10_000, 5_003]
