from __future__ import annotations

import gzip
import os

import pytest
from pyspark.sql import functions as F

from peneira.sources.delimited import header_names, infer_types
from peneira.sources import (
    inline_rows,
    read_csv,
    read_csv_with_preamble,
    read_json,
    read_lines,
    read_parquet,
    read_partition,
    split_fields,
    spread,
)
from peneira.sinks import write_csv, write_partitioned
from plan import settings


def put(folder: str, name: str, data: bytes | str) -> str:
    path = os.path.join(folder, name)
    with open(path, "wb") as file:
        file.write(data.encode() if isinstance(data, str) else data)
    return path


def values(df) -> list:
    return [row[0] for row in df.collect()]


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_lines_keep_blanks_and_empty_lines(spark, folder):
    put(folder, "a.txt", " one \n\ntwo\r\n three\rfour \n\r\nsão\r\r\n")
    lines = [" one ", "", "two", " three\rfour ", "", "são\r"]
    assert values(read_lines(spark, folder)) == lines
    assert values(read_lines(spark, folder, skip=1)) == lines[1:]


def test_skip_is_per_file(spark, folder):
    for name in "abc":
        put(folder, f"{name}.txt", f"head {name}\n{name}1\n{name}2\n")
    assert sorted(values(read_lines(spark, folder, skip=1))) == ["a1", "a2", "b1", "b2", "c1", "c2"]
    assert sorted(values(read_lines(spark, folder, skip=2))) == ["a2", "b2", "c2"]
    assert values(read_lines(spark, folder, skip=9)) == []


def test_skip_over_many_splits_of_many_files(spark, folder):
    expected = []
    for i in range(7):
        lines = [f"file {i} line {n:06d}" for n in range(i * 997)]
        expected += lines[3:]
        put(folder, f"{i}.txt", "".join(line + "\n" for line in lines))
    for size, cost in [(4096, 0), (16384, 1024), (10_000_000, 0)]:
        with settings(
            spark,
            spark__sql__files__maxPartitionBytes=size,
            spark__sql__files__openCostInBytes=cost,
            spark__sql__execution__arrow__maxRecordsPerBatch=100,
        ):
            rows = read_lines(spark, folder, skip=3)
            assert sorted(values(rows)) == sorted(expected)
    assert rows.columns == ["value"]


def test_skip_beyond_the_first_split_is_an_error_not_a_wrong_result(spark, folder):
    put(folder, "a.txt", "".join(f"line {n}\n" for n in range(10_000)))
    with settings(
        spark, spark__sql__files__maxPartitionBytes=1000, spark__sql__files__openCostInBytes=0
    ):
        with pytest.raises(Exception, match="lines to skip"):
            read_lines(spark, folder, skip=5000).collect()


def test_preamble_compressed_and_plain(spark, folder):
    text = "Updated: today\nid;name\n1;a\n2;\n\nx;b\n"
    put(folder, "a.csv", text)
    put(folder, "b.csv.gz", gzip.compress(text.encode()))
    rows = read_csv_with_preamble(spark, folder, "id int, name string", preamble=1, sep=";").collect()
    assert sorted(map(tuple, rows), key=str) == sorted([(1, "a"), (2, None), (None, "b")] * 2, key=str)


def test_preamble_header_is_checked_or_taken(spark, folder):
    put(folder, "a.csv", "Updated: today\r\nname;id\r\na;7\r\nb;8\r\n")
    put(folder, "b.csv", "Updated: now\nname;id\nc;9\n")
    with pytest.raises(Exception, match="the header of"):
        read_csv_with_preamble(spark, folder, "id int, name string", preamble=1, sep=";").collect()
    rows = read_csv_with_preamble(spark, folder, preamble=1, sep=";")
    assert rows.dtypes == [("name", "string"), ("id", "int")]
    assert sorted(map(tuple, rows.collect())) == [("a", 7), ("b", 8), ("c", 9)]
    put(folder, "c.csv", "Updated: now\nid;name\n9;c\n")
    with pytest.raises(Exception, match="the header of"):
        read_csv_with_preamble(spark, folder, preamble=1, sep=";").collect()


def test_quoted_headers_below_a_preamble(spark, folder):
    put(folder, "a.csv", 'Updated: today\n"id";"name; and"\n1;"a;b"\n')
    put(folder, "b.csv", 'Updated: now\r\n\ufeffID;"name; and"\r\n2;c\r\n')
    for schema in ("id int, `name; and` string", None):
        rows = read_csv_with_preamble(spark, folder, schema, preamble=1, sep=";")
        assert rows.columns == ["id", "name; and"]
        assert sorted(map(tuple, rows.collect())) == [(1, "a;b"), (2, "c")]
    with settings(spark, spark__sql__caseSensitive="true"):
        with pytest.raises(Exception, match="the header of"):
            read_csv_with_preamble(spark, folder, "id int, `name; and` string", preamble=1, sep=";").collect()
    put(folder, "c.csv", 'Updated: now\n"name; and";"id"\nd;3\n')
    with pytest.raises(Exception, match="the header of"):
        read_csv_with_preamble(spark, folder, "id int, `name; and` string", preamble=1, sep=";").collect()


def test_header_names():
    for line, sep, names in [
        ("a,b", ",", ["a", "b"]),
        ('"a";"b"', ";", ["a", "b"]),
        ('"a,""x""",b', ",", ['a,"x"', "b"]),
        ('"a"||b||"c||d"', "||", ["a", "b", "c||d"]),
        ("", ",", [""]),
        ('a,"",', ",", ["a", "", ""]),
        ('"open,b', ",", ["open,b"]),
    ]:
        assert header_names(line, sep, '"') == names
    assert header_names("'a,b',c", ",", "'") == ["a,b", "c"]


def test_foreign_texts_like_the_null_mark_stay(spark, folder):
    put(folder, "a.csv", "1,\\\\N\n2,\\N\n3,\\\\\\N\n")
    schema = "id int, text string"
    assert bag(read_csv(spark, folder, header=False, schema=schema)) == [(1, "\\\\N"), (2, None), (3, "\\\\\\N")]
    assert bag(read_csv(spark, folder, header=False, schema=schema, own_marks=True))[0] == (1, "\\N")
    put(folder, "p.csv", "x\nid,text\n1,\\\\N\n")
    assert read_csv_with_preamble(spark, folder + "/p.csv", schema, preamble=1).first().text == "\\\\N"
    own = inline_rows(spark, [(1, "\\N"), (2, "\\\\N"), (3, None)], schema)
    write_csv(own, folder + "/own")
    for path in (folder + "/own", folder + "/ow*", folder + "/own/*.csv", [folder + "/own"]):
        assert bag(read_csv(spark, path, header=False, schema=schema)) == bag(own)
    with pytest.raises(ValueError, match="own_marks"):
        read_csv(spark, [folder + "/own", folder + "/a.csv"], header=False, schema=schema)


def test_inferred_types(spark):
    rows = inline_rows(
        spark,
        [("1", "1", "1.5", "2024-01-02", "true", "x", None), ("-2", "5000000000", "2", None, "false", "1", None)],
        "a string, b string, c string, d string, e string, `f.g` string, h string",
    )
    assert [kind for _, kind in infer_types(rows).dtypes] == [
        "int", "bigint", "double", "date", "boolean", "string", "string",
    ]


def test_csv_mark_crlf_accents_and_quotes(spark, folder):
    put(folder, "a.csv", '﻿id,name\r\n1,José\r\n2,"a ""b"", c"\r\n3,\r\n')
    rows = read_csv(spark, folder, header=True, schema="id int, name string").collect()
    assert [tuple(r) for r in rows] == [(1, "José"), (2, 'a "b", c'), (3, None)]
    assert read_csv(spark, folder, header=True).dtypes == [("id", "int"), ("name", "string")]


def test_csv_header_must_fit_the_schema(spark, folder):
    put(folder, "a.csv", "id,name\n1,a\n")
    with pytest.raises(Exception, match="does not conform"):
        read_csv(spark, folder, header=True, schema="name string, id string").collect()


def test_csv_header_is_asked_for(spark, folder):
    put(folder, "a.csv", "1,a\n2,b\n")
    with pytest.raises(TypeError):
        read_csv(spark, folder)
    assert read_csv(spark, folder, header=False).columns == ["_c0", "_c1"]
    assert read_csv(spark, folder, header=False).count() == 2


def test_null_text(spark, folder):
    put(folder, "a.csv", "id,boss\n1,NULL\n2,1\n")
    rows = read_csv(spark, folder, header=True, schema="id int, boss int", nullValue="NULL").collect()
    assert [tuple(r) for r in rows] == [(1, None), (2, 1)]


def test_split_fields(spark):
    rows = inline_rows(spark, [("a.b||c",), ("x",), (None,)], "line string")
    got = rows.select(*split_fields("line", "|", ["f0", "f1", "f2", "f3"])).collect()
    assert [tuple(r) for r in got] == [("a.b", "", "c", None), ("x", None, None, None), (None,) * 4]


def test_json_one_array(spark, folder):
    put(folder, "a.json", '[{"b": 1, "a": "x"},\n {"b": null, "a": "y"}]')
    rows = read_json(spark, folder, multiLine=True)
    assert rows.columns == ["a", "b"]  # inference orders by name
    assert sorted(map(tuple, rows.collect())) == [("x", 1), ("y", None)]


def test_partition_values_keep_their_type(spark, folder):
    rows = inline_rows(spark, [(1, "01"), (2, "02"), (3, None)], "id int, uf string")
    write_partitioned(rows, folder + "/p", ["uf"])
    back = read_parquet(spark, folder + "/p", rows.schema)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)
    assert [tuple(r) for r in read_partition(spark, folder + "/p", {"uf": "01"}, rows.schema).collect()] == [
        (1, "01")
    ]


def test_only_the_partitions_folder_is_listed(spark, folder):
    rows = spark.range(600).select("id", (F.col("id") % 3).cast("string").alias("a"), (F.col("id") % 2 == 0).alias("b"))
    write_partitioned(rows, folder + "/p", ["a", "b"])
    one = read_partition(spark, folder + "/p", {"a": "1", "b": True}, rows.schema)
    assert one.count() == 100 and one.columns == rows.columns
    assert one.inputFiles() and all("/a=1/b=true/" in f for f in one.inputFiles())
    assert len(one.inputFiles()) < len(read_parquet(spark, folder + "/p", rows.schema).inputFiles())
    assert read_partition(spark, folder + "/p", {"b": True}, rows.schema).count() == 300  # not from the root: filtered
    assert read_partition(spark, folder + "/p", {"a": "7"}, rows.schema).count() == 0


def test_null_and_odd_partition_values(spark, folder):
    rows = inline_rows(spark, [(1, "a/b"), (2, None), (3, "x=y %")], "id int, k string")
    write_partitioned(rows, folder + "/p", ["k"])
    for i, value in ((1, "a/b"), (2, None), (3, "x=y %")):
        found = read_partition(spark, folder + "/p", {"k": value}, rows.schema)
        assert [tuple(r) for r in found.collect()] == [(i, value)]
        assert len(found.inputFiles()) == 1


def test_inline_rows(spark):
    assert inline_rows(spark, [], "a int, b string").collect() == []
    assert inline_rows(spark, [(1,)] * 100_001, "a int").count() == 100_001


def test_spread_keeps_every_row(spark):
    rows = spark.range(1000).coalesce(1)
    assert spread(rows).count() == 1000
    assert spread(rows, "id").count() == 1000
