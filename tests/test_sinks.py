from __future__ import annotations

import datetime
import glob
import os
import tempfile
import uuid
import warnings

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from peneira.sinks import (
    TableSpec,
    bulk_load,
    register_view,
    save_table,
    write_csv,
    write_json,
    write_parquet,
    write_partitioned,
    write_text,
)
from peneira.sinks import files
from peneira.sources import inline_rows, read_csv, read_json, read_lines, read_parquet
from plan import settings as spark_settings

SCHEMA = "id long, name string, price double, day date, at timestamp_ntz, n int"
ROWS = [
    (1, " padded ", 0.1, datetime.date(2019, 4, 27), datetime.datetime(2024, 1, 1, 0, 0, 7, 179575), 1),
    (2, 'quote " and , and ; and \\', -0.0, None, None, None),
    (3, "São Luís", 1e300, datetime.date(1900, 1, 1), datetime.datetime(1999, 12, 31, 23, 59, 59), -5),
    (4, None, None, None, datetime.datetime(2024, 1, 1), 0),
]


def bag(df) -> list:
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("compression", [None, "gzip"])
@pytest.mark.parametrize("kind", ["csv", "csv-semicolon", "csv-noheader", "json", "parquet", "partitioned"])
def test_round_trip(spark, folder, kind, compression):
    rows = inline_rows(spark, ROWS, SCHEMA)
    path = f"{folder}/out"
    if kind.startswith("csv"):
        how = {"header": kind != "csv-noheader", "sep": ";" if kind == "csv-semicolon" else ","}
        write_csv(rows, path, compression=compression, **how)
        back = read_csv(spark, path, schema=rows.schema, **how)
    elif kind == "json":
        write_json(rows, path, compression)
        back = read_json(spark, path, rows.schema)
    elif kind == "parquet":
        write_parquet(rows, path, compression)
        back = read_parquet(spark, path)
    else:
        write_partitioned(rows, path, ["n"], compression)
        back = read_parquet(spark, path, rows.schema).select(*rows.columns)
    assert bag(back) == bag(rows)
    ending = ".gz*" if compression else ""
    assert glob.glob(f"{path}/**/part-*{ending}", recursive=True)


texts = st.text(st.characters(codec="utf-8", exclude_categories=["Cs", "Cc"]) | st.sampled_from('",;\\ \t'))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.integers(-(2**63), 2**63 - 1), st.none() | texts), min_size=1, max_size=30))
def test_any_text_survives_csv_and_json(spark, rows):
    folder = tempfile.mkdtemp(prefix="peneira-test-")
    df = inline_rows(spark, rows, "id long, name string")
    write_json(df, folder + "/json")
    assert bag(read_json(spark, folder + "/json", df.schema)) == sorted(rows, key=repr)
    write_csv(df, folder + "/csv", header=True)
    assert bag(read_csv(spark, folder + "/csv", header=True, schema=df.schema)) == sorted(rows, key=repr)


def test_line_breaks_in_csv(spark, folder):
    df = inline_rows(spark, [(1, "a\nb"), (2, "c\r\nd"), (3, "e\rf")], "id int, text string")
    write_csv(df, folder + "/c", header=True)
    back = read_csv(spark, folder + "/c", header=True, schema=df.schema, multiLine=True, lineSep="\n")
    assert bag(back) == bag(df)


def test_a_single_null_column_keeps_its_rows(spark, folder):
    df = inline_rows(spark, [("a",), (None,), ("b",), (None,)], "name string")
    write_csv(df, folder + "/c")
    assert bag(read_csv(spark, folder + "/c", header=False, schema=df.schema)) == bag(df)


def test_the_null_mark_as_text(spark, folder):
    rows = [(i, t) for i, t in enumerate([None, "", "\\N", "\\\\N", "N", "\\", "\\Nn", " \\N"])]
    df = inline_rows(spark, rows, "id int, text string")
    write_csv(df, folder + "/c")
    assert bag(read_csv(spark, folder + "/c", header=False, schema=df.schema)) == bag(df)
    write_csv(df, folder + "/n", nullValue="NULL")
    back = read_csv(spark, folder + "/n", header=False, schema=df.schema, nullValue="NULL")
    assert bag(back) == bag(df)


def test_text_that_would_break_lines_is_refused(spark, folder):
    for value in ("a\nb", "a\rb", "a|b"):
        rows = inline_rows(spark, [(1, value)], "id int, text string")
        with pytest.raises(Exception, match="line break or separator"):
            write_text(rows, folder + "/t", sep="|")
    write_text(rows, folder + "/t", sep="|", strict=False)
    write_text(rows.select("text"), folder + "/one", sep="|")
    assert [r.value for r in read_lines(spark, folder + "/one").collect()] == ["a|b"]


def test_partitions_without_adaptive_execution(spark, folder):
    """Each value is written whole by one task, without a warning, as with adaptive execution."""
    for adaptive in ("true", "false"):
        with spark_settings(spark, spark__sql__adaptive__enabled=adaptive), warnings.catch_warnings():
            warnings.simplefilter("error", UserWarning)
            write_partitioned(spark.range(0, 300, 1, 5).selectExpr("id", "id % 3 AS k"), folder + "/p", ["k"])
        assert [len(glob.glob(f"{folder}/p/k={k}/part-*")) for k in range(3)] == [1, 1, 1]


def test_text_lines(spark, folder):
    write_text(inline_rows(spark, ROWS[:2], SCHEMA).select("id", "n", "name"), folder + "/t", sep="|")
    assert sorted(r.value for r in read_lines(spark, folder + "/t").collect()) == [
        "1|1| padded ",
        '2||quote " and , and ; and \\',
    ]


def test_overwrite(spark, folder):
    for n in (5, 3):
        write_parquet(spark.range(n), folder + "/p")
    assert read_parquet(spark, folder + "/p").count() == 3


def test_a_frequent_partition_value_is_written_by_several_tasks(spark, folder):
    rows = spark.range(0, 400_000, 1, 16).select(
        "id", F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise((F.col("id") % 5).cast("string")).alias("k")
    )
    size = 256 * 1024
    with spark_settings(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes=size):
        write_partitioned(rows, folder + "/p", ["k"])
    assert len(glob.glob(folder + "/p/k=hot/part-*")) > 2
    assert len(glob.glob(folder + "/p/k=1/part-*")) <= 2
    back = read_parquet(spark, folder + "/p", rows.schema)
    assert back.count() == 400_000
    assert back.agg(F.sum("id")).first()[0] == sum(range(400_000))


@pytest.mark.parametrize("adaptive", ["true", "false"])
@pytest.mark.parametrize("by", [["k"], ["k", "l"]])
def test_a_frequent_value_from_one_file_is_written_by_several_tasks(spark, folder, adaptive, by):
    rows = spark.range(0, 60_000, 1, 1).select(
        "id",
        F.when(F.col("id") % 10 > 0, F.lit("hot")).when(F.col("id") % 20 == 0, F.lit("x")).alias("k"),
        (F.col("id") % 1000 == 1).alias("l"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )
    rows.write.parquet(folder + "/one")
    one = read_parquet(spark, folder + "/one", rows.schema)
    assert len(glob.glob(folder + "/one/part-*")) == 1
    found = [r.writers for r in files.large_values(files.value_bytes(one, by), 400_000).collect()]
    assert len(found) == 1 and 11 <= found[0] <= 13
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": 400_000, "spark.sql.adaptive.enabled": adaptive}
    with spark_settings(spark, **{k.replace(".", "__"): v for k, v in small.items()}):
        write_partitioned(one, folder + "/p", by)
    hot = folder + "/p/k=hot" + ("/l=false" if len(by) == 2 else "")
    assert 4 <= len(glob.glob(hot + "/part-*")) <= 13
    assert len(glob.glob(hot.replace("hot", "x") + "/part-*")) == 1
    assert max(os.path.getsize(f) for f in glob.glob(hot + "/part-*")) < 0.5 * os.path.getsize(glob.glob(folder + "/one/part-*")[0])
    back = read_parquet(spark, folder + "/p", rows.schema)
    assert back.select(*one.columns).exceptAll(one).isEmpty() and back.count() == 60_000


def test_sizes_of_any_columns(spark, folder):
    rows = spark.range(20).selectExpr(
        "CASE WHEN id > 3 THEN 'a' END AS `k.1`", "array(id) AS a", "map('x', id) AS m", "struct(id) AS s", "CAST(NULL AS STRING) AS t",
        "CAST('b' AS BINARY) AS b", "id % 2 = 0 AS f", "DATE '2024-01-01' AS d",
    )
    write_partitioned(rows, folder + "/p", ["k.1"], task_bytes=100)
    assert read_parquet(spark, folder + "/p", rows.schema).count() == 20
    assert files.large_values(files.value_bytes(rows, ["k.1"]), 10**6).count() == 0


def test_tables_views_and_bulk_load(spark, folder):
    schema = "peneira_test_" + uuid.uuid4().hex[:8]
    table = save_table(spark.range(4), f"{schema}.numbers", f"{folder}/{schema}")
    assert table.count() == 4
    assert save_table(spark.range(2), f"{schema}.numbers").count() == 2
    assert glob.glob(f"{folder}/{schema}/numbers/*.parquet")
    register_view(spark.table(f"{schema}.numbers"), "peneira_test_view")
    assert spark.sql("SELECT max(id) AS m FROM peneira_test_view").first().m == 1
    specs = {}
    for name, n in [("brands", 9), ("stores", 3), ("none", 0)]:
        write_csv(spark.range(n).select("id", (F.col("id") * 2).alias("twice")), f"{folder}/{name}", header=True)
        specs[name] = TableSpec(f"{folder}/{name}", "id long, twice long", options={"header": True})
    report = bulk_load(spark, specs, schema)
    assert bag(report) == [("brands", 9, 2, 0), ("none", 0, 2, 0), ("stores", 3, 2, 0)]
    assert bag(spark.table(f"{schema}.stores")) == [(0, 0), (1, 2), (2, 4)]


def test_bulk_load_checks_headers_and_counts_rejects(spark, folder):
    schema = "peneira_test_" + uuid.uuid4().hex[:8]
    write_text(inline_rows(spark, [("id,name",), ("bad,y",), ("8,z",)], "line string").coalesce(1), folder + "/x")
    swapped = TableSpec(folder + "/x", "name string, id int", options={"header": True})
    with pytest.raises(Exception, match="does not conform"):
        bulk_load(spark, {"x": swapped}, schema, f"{folder}/{schema}")
    fitting = TableSpec(folder + "/x", "id int, name string", options={"header": True})
    assert bag(bulk_load(spark, {"x": fitting}, schema, f"{folder}/{schema}")) == [("x", 2, 2, 1)]
    assert bag(spark.table(f"{schema}.x")) == sorted([(None, "y"), (8, "z")], key=repr)
