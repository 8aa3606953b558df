"""Every registered query against its SQL twin."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from compare import connect, duck_bag, spark_bag
from peneira.operators.profile import compare_formats
from peneira.plans.registry import load_all

INVENTORY = (
    [f"S{i:02d}" for i in range(1, 16)]
    + [f"K{i:02d}" for i in range(1, 13)]
    + [f"P{i:02d}" for i in range(1, 11)]
    + [f"F{i:02d}" for i in range(1, 17)]
    + ["J01"]
    + [f"A{i:02d}" for i in range(1, 9)]
    + ["O01", "O02", "U01"]
    + [f"X{i:02d}" for i in range(1, 19)]
    + [f"N{i:02d}" for i in range(1, 11)]
    + [f"V{i:02d}" for i in range(1, 6)]
    + ["M01", "M02"]
)
QUERIES = {name: q.run for name, q in load_all().items()}
SQL = {name: q.sql for name, q in load_all().items() if q.sql is not None}


@pytest.fixture(scope="module")
def db(sf_dir):
    return connect(sf_dir)


def test_the_whole_inventory_is_registered():
    assert len(INVENTORY) == 100
    assert {q.operator for q in load_all().values()} == set(INVENTORY)


def test_entry(spark):
    result = entry_points.entry(spark)
    assert result.columns == ["l_suppkey", "n_lines", "quantity"]
    assert result.count() > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, sf_dir, db, name):
    columns, rows = spark_bag(QUERIES[name](spark, sf_dir))
    wanted_columns, wanted = duck_bag(db, SQL[name])
    assert columns == wanted_columns
    assert rows == wanted
    assert sum(rows.values()) > 0


@pytest.mark.parametrize("name", ["cmb_cogroup", "job_standardise_text", "agg_delay_summary", "prf_table"])
def test_same_as_sql_at_another_scale(spark, name):
    other = "/root/testdata/sf0.001"
    assert spark_bag(QUERIES[name](spark, other)) == duck_bag(connect(other), SQL[name])


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_points.queries()) and set(SQL) <= set(entry_points.oracle_sql())


def test_format_comparison(spark, sf_dir, folder):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    rows = {(r.format, r.compression): r for r in compare_formats(lines, folder).collect()}
    assert len(rows) == 6
    assert rows["parquet", "default"].n_bytes < rows["csv", "default"].n_bytes < rows["json", "default"].n_bytes
    assert rows["json", "gzip"].n_bytes < rows["json", "default"].n_bytes
    assert all(r.n_files > 0 and r.scan_seconds > 0 for r in rows.values())


def test_blocks_are_met(spark, sf_dir):
    assert QUERIES["cmb_cogroup_blocks"](spark, sf_dir).filter("block > 0").count() > 0
