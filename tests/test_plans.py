"""The physical plans: what is scanned, pushed down and shuffled."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from peneira.functions.predicates import keep_listed
from peneira.operators.aggregates import first_rows, null_counts
from peneira.operators.combine import align, co_group
from peneira.operators.projections import key_value
from peneira.plans.inputs import orders_n, table
from peneira.plans.registry import load_all
from peneira.sinks import write_partitioned
from peneira.sources import inline_rows, read_partition
from plan import count, physical, settings

QUERIES = {name: q.run for name, q in load_all().items()}
PYTHON = {"udf_map", "udf_filter", "udf_flatmap", "udf_pardo", "udf_combine", "src_skip_first_line", "src_csv_preamble", "src_csv_preamble_inferred"}


@pytest.fixture(scope="module")
def plans(spark, sf_dir):
    eager = {"prf_format_bytes"}
    return {name: physical(run(spark, sf_dir)) for name, run in QUERIES.items() if name not in eager}


def test_no_cross_joins_and_no_single_task_gathering(plans):
    for name, plan in plans.items():
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
        assert "Window" not in plan, name
        if "SinglePartition" in plan:  # only for the final rows of an aggregate without keys
            assert "partial_" in plan, name


def test_python_only_where_it_is_the_feature(plans):
    for name, plan in plans.items():
        python = any(word in plan for word in ("ArrowEvalPython", "MapInArrow", "BatchEvalPython", "Pandas"))
        assert python == (name in PYTHON), name


def test_flagship_reads_three_columns_and_shuffles_once_per_step(spark, sf_dir):
    result = QUERIES["agg_delay_summary"](spark, sf_dir)
    plan = physical(result)
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double,l_returnflag:string>" in plan
    assert "EqualTo(l_returnflag,R)" in plan
    assert count(result, "FileScan parquet") == 1
    assert plan.count("hashpartitioning") == 1 and plan.count("rangepartitioning") == 1


def test_null_profile_is_one_scan(spark, sf_dir):
    result = null_counts(orders_n(spark, sf_dir))
    assert count(result, "FileScan parquet") == 1
    assert count(result, "Exchange") == 1


def test_formats_are_read_once(spark, folder):
    lines = "l_orderkey long, l_quantity double, l_returnflag string, l_shipdate timestamp"
    rows = [(1, 2.0, "A", None), (1, 2.0, "A", None), (None, None, None, None), (5, 1.5, "R", None)]
    inline_rows(spark, rows, lines).write.parquet(f"{folder}/lineitem.parquet")
    result = QUERIES["prf_format_bytes"](spark, folder)
    # The rows were read back by the scan that was timed; the result has only its aggregates.
    assert "FileScan csv" not in physical(result) and "FileScan json" not in physical(result)
    assert count(result, "FileScan parquet") == 6
    assert sorted(result.collect()) == [
        (name, compression, 4, 7, 5.5, 2) for name in ("csv", "json", "parquet") for compression in ("default", "gzip")
    ]


def test_formats_leave_only_what_the_result_reads(spark, folder, monkeypatch):
    lines = "l_orderkey long, l_quantity double, l_returnflag string"
    rows = [(k, float(k % 50), "ANR"[k % 3]) for k in range(3000)]
    inline_rows(spark, rows, lines).write.parquet(f"{folder}/lineitem.parquet")
    monkeypatch.setattr("peneira.plans.profile_queries.new_folder", lambda *_: f"{folder}/formats")
    result = QUERIES["prf_format_bytes"](spark, folder)
    assert sorted(p.name for p in Path(folder, "formats").iterdir()) == sorted(
        f"contents-{name}-{compression}" for name in ("csv", "json", "parquet") for compression in ("default", "gzip")
    )
    assert {tuple(r)[2:] for r in result.collect()} == {(3000, sum(range(3000)), float(sum(k % 50 for k in range(3000))), 3)}


def test_pushed_filters(spark, sf_dir):
    for name, pushed in [
        ("flt_text_eq", "EqualTo(o_orderstatus,F)"),
        ("flt_range_half_open", "GreaterThanOrEqual(o_totalprice,30000.0)"),
        ("flt_like_prefix", "StringStartsWith(p_name,small)"),
        ("flt_like_contains", "StringContains(p_name,ed)"),
        ("flt_sql_query", "EqualTo(o_orderpriority,2-HIGH)"),
    ]:
        with settings(spark, spark__sql__maxMetadataStringLength=1000):
            assert pushed in physical(QUERIES[name](spark, sf_dir)), name


def test_one_partition_is_pruned(spark, sf_dir, folder):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus")
    write_partitioned(lines, folder + "/p", ["l_returnflag", "l_linestatus"])
    one = read_partition(spark, folder + "/p", {"l_returnflag": "R", "l_linestatus": "O"}, lines.schema)
    plan = physical(one)
    start = plan.index("PartitionFilters")
    assert "(l_returnflag" in plan[start : start + 200] and "(l_linestatus" in plan[start : start + 300]
    files = one.select(F.input_file_name().alias("file")).distinct().collect()
    assert files and all("l_returnflag=R/l_linestatus=O" in r.file for r in files)


def test_long_list_is_joined_by_its_size(spark, sf_dir):
    assert "BroadcastHashJoin" in physical(QUERIES["flt_in_long_list"](spark, sf_dir))
    with settings(spark, spark__sql__autoBroadcastJoinThreshold=10):
        assert "BroadcastHashJoin" not in physical(QUERIES["flt_in_long_list"](spark, sf_dir))


def test_the_list_reaches_the_scan(spark, sf_dir):
    with settings(spark, spark__sql__maxMetadataStringLength=4000):
        plan = physical(QUERIES["flt_in_long_list"](spark, sf_dir))
        assert "GreaterThanOrEqual(c_name,Customer#000000400)" in plan and "LessThanOrEqual(c_name,Customer#000002399)" in plan
        plan = physical(QUERIES["flt_in_table"](spark, sf_dir))
        assert "GreaterThanOrEqual(o_orderkey,2" in plan and "LessThanOrEqual(o_orderkey," in plan
        assert "l_quantity" not in plan  # the list is computed once, and stored
        customers = table(spark, sf_dir, "customer")
        for n in (1, 1_000, 100_001):
            kept = keep_listed(customers, "c_custkey", list(range(7, 7 + n)))
            plan = physical(kept)
            if n == 1:
                assert "EqualTo(c_custkey,7)" in plan
            else:
                assert "GreaterThanOrEqual(c_custkey,7)" in plan and f"LessThanOrEqual(c_custkey,{6 + n})" in plan
            assert kept.count() == customers.filter(F.col("c_custkey").between(7, 6 + n)).count()
        tokens = physical(QUERIES["flt_in_list"](spark, sf_dir))
        assert " >= and)" in tokens and " <= the)" in tokens and " IN (" in tokens


def test_co_group_without_frequent_keys_shuffles_once(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    inputs = {
        tag: key_value(orders.filter(F.col("o_orderstatus") == tag), "o_custkey", "o_orderkey") for tag in "OF"
    }
    grouped = co_group(inputs, 10_000)
    assert count(grouped, "Exchange hashpartitioning") == 1
    assert "o_orderkey" not in physical(grouped)  # the inputs were read once, into the shared folder
    assert "collect_list" not in physical(align(inputs))


def test_co_group_blocks_are_shuffled_apart(spark, sf_dir, monkeypatch):
    orders = key_value(table(spark, sf_dir, "orders"), "o_custkey", "o_orderkey")
    plan = physical(co_group({"a": orders}, block_size=5))
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan
    assert "Exchange hashpartitioning(key#" in plan and ", block#" in plan.split("Exchange hashpartitioning")[1][:40]
    monkeypatch.setattr("peneira.operators.combine.BROADCAST_KEYS", 0)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold=-1):
        plan = physical(co_group({"a": orders}, block_size=5))
    assert "BroadcastExchange" not in plan
    assert "hashpartitioning(coalesce(key" in plan and ", salt#" in plan
    assert plan.count("Exchange hashpartitioning(key#") >= 1 and ", block#" in plan.split("Exchange hashpartitioning(key#")[1][:40]


def test_each_source_of_a_co_group_is_scanned_once(spark, sf_dir):
    for name in ("cmb_cogroup", "cmb_cogroup_blocks"):
        with settings(spark, spark__sql__maxMetadataStringLength=1000):
            plan = physical(QUERIES[name](spark, sf_dir))
        assert "orders.parquet" not in plan and "/tagged-" in plan, name


def test_preview_is_not_a_full_sort(spark, sf_dir):
    assert "TakeOrderedAndProject" in physical(first_rows(table(spark, sf_dir, "customer"), 20, "c_custkey"))
