"""Columns, filters, aggregates, nulls and combinations on small rows."""

from __future__ import annotations

import math
import random
from collections import defaultdict
from decimal import Decimal
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from peneira.functions.predicates import (
    all_of,
    any_of,
    closed,
    differs,
    equals_ignoring_case,
    equals_standardised,
    equals_trimmed,
    half_open,
    keep_listed,
)
from peneira.functions.text import ACCENTED, PLAIN, split_on, standardise, strip_accents
from peneira.operators.aggregates import (
    count_per_key,
    count_where,
    first_rows,
    null_counts,
    ranked_counts,
    row_count,
    sum_per_key,
    summary_per_key,
)
from peneira.operators import combine
from peneira.operators.combine import align, co_group, flatten, tagged_rows
from peneira.operators.nulls import cast_then_fill, fill, fill_then_cast, with_defaults
from peneira.operators.profile import compare_formats, read_format, table_profile
from peneira.operators.projections import at, cast_with_rejects, explode_tokens, key_value, rename, with_cast
from peneira.sinks import write_json
from peneira.sources import inline_rows


def values(df) -> list:
    return sorted((r[0] if len(r) == 1 else tuple(r) for r in df.collect()), key=repr)


def words(spark, *texts):
    return inline_rows(spark, [(t,) for t in texts], "t string")


@pytest.mark.parametrize(
    ("text", "plain"),
    [("ÁGUA", "agua"), (" São Paulo ", "sao paulo"), ("ção", "cao"), ("Ñandú", "ñandu"), ("", ""), (None, None)],
)
def test_standardise(spark, text, plain):
    assert values(words(spark, text).select(standardise("t"))) == [plain]


def test_strip_accents_leaves_capitals(spark):
    assert values(words(spark, "Água água").select(strip_accents("t"))) == ["Água agua"]


@pytest.mark.parametrize("separator", [" ", ",", "|", ".", "\n", "ab", "||", "#", "^", "\\", "a.c"])
def test_split_is_literal(spark, separator):
    text = f"x{separator}{separator}y.z{separator}"
    assert values(words(spark, text).select(F.to_json(split_on("t", separator)))) == values(
        words(spark, text).select(F.to_json(F.array(*[F.lit(p) for p in text.split(separator)])))
    )


def test_explode_tokens_like_python(spark):
    text = " a  b \nc\n\n d"
    expected = [w for line in text.split("\n") for w in line.split(" ")]
    assert values(explode_tokens(words(spark, text, ""), "t")) == sorted([*expected, ""], key=repr)


def test_rename_checks_names(spark):
    df = spark.range(1)
    assert rename(df, {"id": "n"}).columns == ["n"]
    with pytest.raises(ValueError, match="no such columns"):
        rename(df, {"nope": "n"})


def test_key_value_and_position(spark):
    df = inline_rows(spark, [(1, "a", 2.9)], "i int, `s p` string, d double")
    assert values(key_value(df, "i", F.col("d").cast("int"))) == [(1, 2)]
    assert values(df.select(at(df, 1))) == ["a"]


def test_cast_with_rejects(spark):
    df = words(spark, "1", " 5 ", "3.0", "x", "", None, "99999999999")
    good, bad = cast_with_rejects(df, "t")
    assert values(good) == sorted([1, 5, None, None, None, None, None], key=repr)
    assert values(bad) == sorted(["3.0", "x", "", "99999999999"], key=repr)


def test_predicates(spark):
    df = inline_rows(spark, [(i, t) for i, t in enumerate(["a", "b", None, " A", "À "])], "i int, t string")
    keep = lambda p: values(df.filter(p).select("i"))
    assert keep(differs("t", "a")) == [1, 3, 4]
    assert keep(differs("t", "a", keep_null=True)) == [1, 2, 3, 4]
    assert keep(half_open("i", 1, 3)) == [1, 2]
    assert keep(closed("i", 1, 3)) == [1, 2, 3]
    assert keep(all_of(F.col("i") > 0, F.col("i") < 3, F.col("t").isNull())) == [2]
    assert keep(any_of(F.col("i") == 0, F.col("t") == "b")) == [0, 1]
    assert keep(equals_ignoring_case("t", "B")) == [1]
    assert keep(equals_trimmed("t", "A")) == [3]
    assert keep(equals_trimmed("t", "A", "left")) == [3]
    assert keep(equals_trimmed("t", "A", "right")) == []
    assert keep(equals_standardised("t", "Á")) == [0, 3, 4]


def test_keep_listed_short_and_long_agree(spark):
    df = spark.range(5000).select((F.col("id") % 2000).cast("int").alias("k"))
    short, long = list(range(0, 1000, 2)), list(range(0, 4000, 2)) * 2
    assert keep_listed(df, "k", short).count() == df.filter(F.col("k").isin(short)).count()
    assert values(keep_listed(df, "k", long)) == values(df.filter(F.col("k") % 2 == 0))
    assert keep_listed(df, "k", []).count() == 0
    assert values(keep_listed(df, "k", spark.range(0, 4000, 2))) == values(keep_listed(df, "k", long))


@pytest.mark.parametrize("n", [1_000, 1_001, 100_001])
def test_keep_listed_of_any_length(spark, n):
    df = spark.range(120_000).select(F.col("id").cast("string").alias("a.b"), F.lit(1).alias("listed"))
    assert keep_listed(df, "a.b", [str(i) for i in range(n)]).count() == n
    assert keep_listed(df, "a.b", list(range(n))).count() == n  # converted to the column's type
    assert keep_listed(df, "listed", list(range(n))).count() == 120_000


def test_keep_listed_of_mixed_types(spark):
    df = inline_rows(spark, [(1,), (2,), (3,), (None,)], "k int")
    assert values(keep_listed(df, "k", [1, "2", 2.5, 3.0, None, Decimal("2.5"), "x"])) == [1, 2, 3]
    assert values(keep_listed(df, "k", [Decimal("3"), 2**40])) == [3]
    texts = inline_rows(spark, [("1",), ("true",), ("x",), (None,)], "t string")
    assert values(keep_listed(texts, "t", ["x", 1])) == ["1", "x"]


@pytest.mark.parametrize("kind", ["byte", "long", "double", "float", "decimal(9,2)", "string", "date", "timestamp", "timestamp_ntz", "boolean", "binary"])
def test_the_condition_before_the_join_loses_no_row(spark, folder, kind):
    how = f"CAST(date_add(DATE '2024-03-01', CAST(id AS INT)) AS {kind})" if kind in ("date", "timestamp", "timestamp_ntz") else None
    how = how or {"boolean": "id % 2 = 0", "binary": "CAST(CAST(id AS STRING) AS BINARY)"}.get(kind, f"CAST(id - 50 AS {kind})")
    df = spark.range(100).selectExpr(f"CASE WHEN id % 9 > 0 THEN {how} END AS k", "id")
    df.write.parquet(folder + "/k")
    df = spark.read.parquet(folder + "/k")
    for n in (0, 1, 3, 40):
        listed = df.filter(F.pmod(F.xxhash64("id"), F.lit(100)) < n).select("k")
        wanted = values(df.join(listed.distinct(), "k", "left_semi"))
        assert values(keep_listed(df, "k", listed)) == wanted
        if kind not in ("timestamp", "timestamp_ntz"):  # Python's datetimes are read in the machine's time zone
            assert values(keep_listed(df, "k", [r.k for r in listed.collect()])) == wanted


def test_keep_listed_zeros_and_nan(spark, folder):
    for k, stored in enumerate((-0.0, 0.0, math.nan, 1.0)):
        path = f"{folder}/{k}"
        spark.createDataFrame([(stored,)] * 3, "k double").write.parquet(path)
        df = spark.read.parquet(path)
        for listed in ([-0.0], [0.0], [math.nan], [math.nan, 2.0], [0.0, 1.0]):
            same = any(x == stored or math.isnan(x) and math.isnan(stored) for x in listed)
            assert keep_listed(df, "k", listed).count() == 3 * same


def test_keep_listed_values_that_do_not_fit(spark):
    df = inline_rows(spark, [(1,), (2,), (None,)], "k int")
    assert values(keep_listed(df, "k", [1.5, 2.0, None])) == [2]
    assert values(keep_listed(df, "k", ["1", "x", "02"])) == [1]
    assert values(keep_listed(df, "k", [2**40, 1])) == [1]
    assert values(keep_listed(df, "k", [None])) == []


def test_names_with_full_stops(spark):
    df = inline_rows(spark, [("A", "7"), (None, "x")], "`a.b` string, `n.n` string")
    assert df.filter(equals_ignoring_case("a.b", "a")).count() == 1
    assert df.filter(differs("a.b", "B", keep_null=True)).count() == 2
    assert values(cast_then_fill(df, "n.n").select("`n.n`")) == [0, 7]
    assert values(with_cast(df, "n.n").select("`n.n`", "rejected")) == sorted([(7, None), (None, "x")], key=repr)
    assert cast_with_rejects(df, "n.n")[1].count() == 1
    assert values(with_defaults(df, {"a.b": "?"}).select("`a.b`")) == ["?", "A"]
    with pytest.raises(ValueError, match="no such columns"):
        with_defaults(df, {"c": 1})


def test_aggregates(spark):
    df = inline_rows(spark, [("a", 1), ("a", None), ("b", 5), (None, 2)], "k string, v long")
    assert values(sum_per_key(df, "k", "v")) == sorted([("a", 1), ("b", 5), (None, 2)], key=repr)
    assert values(count_per_key(df, "k")) == sorted([("a", 2), ("b", 1), (None, 1)], key=repr)
    assert values(summary_per_key(df, "k", "v", where=F.col("v") > 1)) == sorted(
        [("b", 1, 5), (None, 1, 2)], key=repr
    )
    assert [tuple(r) for r in ranked_counts(df, "k", "v").collect()] == [(None, 1), ("a", 1), ("b", 1)]
    assert values(row_count(df)) == [4]
    assert values(count_where(df, big=F.col("v") > 1, none=F.col("k").isNull())) == [(2, 1)]
    assert values(null_counts(df)) == [("k", 1), ("v", 1)]
    assert [r.v for r in first_rows(df, 2, F.desc("v")).collect()] == [5, 2]


def test_aggregates_of_nothing(spark):
    df = inline_rows(spark, [], "k string, v long")
    assert values(sum_per_key(df, "k", "v")) == []
    assert values(row_count(df)) == [0]
    assert values(null_counts(df)) == [("k", 0), ("v", 0)]
    assert co_group({"a": df.selectExpr("k AS key", "v AS value")}, 10).count() == 0
    assert align({"a": df.selectExpr("k AS key", "v AS value")}).count() == 0


def test_nulls(spark):
    df = inline_rows(spark, [(None, None, "x"), ("a", 1.5, None), (None, None, "7")], "t string, d double, n string")
    assert values(fill(df, "?")) == sorted([("?", None, "x"), ("a", 1.5, "?"), ("?", None, "7")], key=repr)
    assert values(fill(df, 0, ["d"]).select("d")) == [0.0, 0.0, 1.5]
    with pytest.raises(TypeError):
        fill(df, 0, ["t"])
    with pytest.raises(TypeError):
        fill(df, "0", ["d"])
    assert values(fill_then_cast(df, "n").select("n")) == sorted([None, 0, 7], key=repr)
    assert values(cast_then_fill(df, "n").select("n")) == [0, 0, 7]
    assert values(with_defaults(df, {"t": "?", "d": -1.0})) == sorted(
        [("?", -1.0, "x"), ("a", 1.5, None), ("?", -1.0, "7")], key=repr
    )


def test_profile(spark):
    df = inline_rows(spark, [("a", 1), ("a", None), (None, 2)], "`odd name` string, v int")
    expected = [("odd name", 0, "string", 1, 1, 3), ("v", 1, "int", 1, 2, 3)]
    assert values(table_profile(df, exact=True)) == expected
    assert values(table_profile(df)) == expected


def test_format_contents_come_from_the_measured_scan(spark, folder):
    rows = [(1, "a", 0.5), (1, "a", 0.5), (2, None, None), (None, "", -1.5), (7, "\\N", 2.0), (8, "é,\"x", 3.0)]
    df = inline_rows(spark, rows, "`odd key` long, t string, v double").coalesce(1)
    contents = [
        F.count("*").alias("n"),
        F.sum("`odd key`").alias("keys"),
        F.sum("v").alias("v"),
        F.count_distinct("t").alias("t"),
        F.max("t").alias("last"),
    ]
    measured = compare_formats(df, folder, contents, rows_per_file=2).collect()
    assert {(r.format, r.compression): r.n_files for r in measured} == {
        (name, compression): 3 for name in ("parquet", "csv", "json") for compression in ("default", "gzip")
    }
    for r in measured:
        found = spark.read.parquet(f"{folder}/contents-{r.format}-{r.compression}")
        assert values(found) == [(6, 19, 4.5, 4, "é,\"x", 5 + 5 + 5)]
        copy = read_format(spark, f"{folder}/{r.format}-{r.compression}", r.format, df.schema)
        assert values(copy) == values(df)


def test_formats_in_portions(spark, folder, monkeypatch):
    rows = [(1, "a", 0.5), (1, "a", 0.5), (2, None, None), (None, "", -1.5), (7, "\\N", 2.0), (8, "é,\"x", 3.0)]
    df = inline_rows(spark, rows, "`odd key` long, t string, v double").coalesce(1)
    there = []

    def held(label: str) -> int:
        return sum(spark.read.text(str(p.parent)).count() for p in Path(folder).glob(f"{label}/*/_SUCCESS"))

    def watched(df, path, **how):
        write_json(df, path, **how)
        there.append((held("json-default"), held("json-gzip"), held("csv-default"), held("csv-gzip")))

    monkeypatch.setattr("peneira.operators.profile.write_json", watched)
    contents = [F.count("*").alias("n"), F.sum("`odd key`").alias("keys"), F.max("v").alias("v")]
    measured = compare_formats(df, folder, contents, rows_per_file=2, by=["t"], rows_at_once=4).collect()
    assert there == [(4, 0, 0, 0), (2, 0, 0, 0), (0, 4, 0, 0), (0, 2, 0, 0)]
    assert {(r.format, r.compression): r.n_files for r in measured} == {
        (name, compression): 3 for name in ("parquet", "csv", "json") for compression in ("default", "gzip")
    }
    assert all(r.n_bytes > 0 and r.write_seconds > 0 and r.scan_seconds > 0 for r in measured)
    for r in measured:
        found = spark.read.parquet(f"{folder}/contents-{r.format}-{r.compression}")
        assert values(found) == sorted(
            [("a", 2, 2, 0.5, 6), (None, 1, 2, None, 1), ("", 1, None, -1.5, 2), ("\\N", 1, 7, 2.0, 3), ("é,\"x", 1, 8, 3.0, 3)],
            key=repr,
        )
    assert {p.name.split("-")[0] for p in Path(folder).iterdir()} == {"contents"}  # the rest is gone
    for most in (1, 100):  # a file at least; all of them
        again = compare_formats(df, f"{folder}/{most}", contents[:1], rows_per_file=2, rows_at_once=most).collect()
        assert [r.n_files for r in again] == [3] * 6
        for r in again:
            found = spark.read.parquet(f"{folder}/{most}/contents-{r.format}-{r.compression}")
            plain = (r.format, r.compression) == ("parquet", "default")
            assert [x.n for x in found.collect()] == ([6] if most == 100 or plain else [2, 2, 2])


def test_formats_of_no_rows_in_portions(spark, folder):
    df = inline_rows(spark, [], "t string, v double")
    compare_formats(df, folder, [F.count("*").alias("n")], rows_at_once=4)
    for label in ("parquet-gzip", "csv-default", "json-gzip"):
        assert values(spark.read.parquet(f"{folder}/contents-{label}")) == [(0, 0)]


def test_flatten_keeps_duplicates_and_matches_by_name(spark):
    a = inline_rows(spark, [(1, "x")], "i int, t string")
    b = inline_rows(spark, [("x", 1), ("y", 2)], "t string, i int")
    assert values(flatten([a, b, a])) == [(1, "x"), (1, "x"), (1, "x"), (2, "y")]


def brute_force(inputs: dict[str, list[tuple]]) -> dict:
    groups: dict = defaultdict(lambda: {tag: [] for tag in inputs})
    for tag, rows in inputs.items():
        for key, value in rows:
            groups[key][tag].append(value)
    return groups


@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize("block_size", [10_000, 50, 7])
def test_co_group_with_a_frequent_key(spark, monkeypatch, block_size, broadcast):
    if not broadcast:
        monkeypatch.setattr("peneira.operators.combine.BROADCAST_KEYS", 0)
    dice = random.Random(3)
    inputs = {
        "a": [(dice.choice(["hot", "hot", "k1", "k2", None]), dice.randrange(400)) for _ in range(900)]
        + [("hot", 42)] * 300  # one value many times over
        + [("only a", None), ("only a", None), ("only a", 1)],
        "b": [(dice.choice(["hot", "k2", "only b"]), dice.randrange(10**9)) for _ in range(200)],
    }
    frames = {tag: inline_rows(spark, rows, "key string, value long") for tag, rows in inputs.items()}
    found: dict = defaultdict(lambda: {tag: [] for tag in inputs})
    blocks: dict = defaultdict(int)
    for row in co_group(frames, block_size).collect():
        blocks[row["key"]] += 1
        for tag in inputs:
            assert row[tag] == sorted(row[tag], key=lambda v: (v is not None, v or 0))
            found[row["key"]][tag] += row[tag]
    order = lambda vs: sorted(vs, key=repr)
    expected = brute_force(inputs)
    assert set(found) == set(expected)
    for key, lists in expected.items():
        for tag in inputs:
            assert order(found[key][tag]) == order(lists[tag])
    assert blocks["only a"] == 1
    if block_size == 10_000:
        assert set(blocks.values()) == {1}
    else:
        most = max(len(v) for v in expected["hot"].values())
        assert blocks["hot"] >= 0.6 * most / block_size


@pytest.mark.parametrize("full", [True, False])
def test_frequent_keys_by_sketch_or_by_counting_all(spark, monkeypatch, full):
    """The same blocks whether the sketch can name the frequent keys or not."""
    if full:  # as with so many rows that the sketch's error is above a block's size
        monkeypatch.setattr("peneira.operators.combine.TABLE", 8)
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, -1).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 7_000).alias("key"),
        F.col("id").alias("value"),
    )
    stored, suspects = combine._stored_with_sketch(rows.withColumn("tag", F.lit("a")), 100)
    assert (suspects is None) if full else (len(suspects) == 2)
    sizes = {(r.key, r.block): len(r.a) for r in co_group({"a": rows}, 100).collect()}
    counts = {r.key: r["count"] for r in rows.groupBy("key").count().collect()}
    assert {k: sum(n for (key, _), n in sizes.items() if key == k) for k in counts} == counts
    assert {k for k, block in sizes if block} == {k for k, n in counts.items() if n > 100} == {-1, None}
    assert max(n for (k, _), n in sizes.items() if k == -1) < 200


def test_inputs_of_a_co_group_are_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(5000).selectExpr("id % 2 AS key", "id AS value").mapInArrow(counted, "key long, value long")
    assert co_group({"a": rows}, 100).selectExpr("sum(size(a))").first()[0] == 5000
    assert seen.value == 5000


def test_align(spark):
    a = inline_rows(spark, [("x", 2), (None, None)], "key string, value long")
    b = inline_rows(spark, [("y", 5), ("x", 7)], "key string, value long")
    assert values(align({"a": a, "b": b})) == sorted([("x", 2, 7), (None, None, None), ("y", None, 5)], key=repr)
    with pytest.raises(Exception, match="several values"):
        align({"a": a.union(a), "b": b}).collect()


def test_co_group_of_one_source(spark):
    rows = inline_rows(spark, [("x", 1), ("x", 2), ("y", 3), (None, 4)], "k string, v long")
    tagged = tagged_rows(rows, "k", {"odd": (F.col("v") % 2 == 1, "v"), "all": (F.lit(True), "v")})
    assert values(co_group(tagged, 10, tags=["odd", "all"])) == sorted(
        [("x", 0, [1], [1, 2]), ("y", 0, [3], [3]), (None, 0, [], [4])], key=repr
    )
    with pytest.raises(ValueError, match="tags"):
        co_group(tagged, 10)


def test_co_group_of_many_frequent_values_stays_in_bounded_blocks(spark):
    rows = spark.range(20_000).select(F.lit(1).alias("key"), F.col("id").alias("value"))
    grouped = co_group({"a": rows}, block_size=500, spread_by=F.col("value"))
    sizes = [len(r["a"]) for r in grouped.collect()]
    assert sizes == [500] * 40


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.text(st.sampled_from("aA zZ\t9áÁçÇñßÀé日")), min_size=1, max_size=60))
def test_plain_text_shortcut_changes_nothing(spark, texts):
    df = words(spark, *texts)
    looked_up = F.trim(F.translate(F.lower("t"), ACCENTED, PLAIN))
    assert df.filter(~standardise("t").eqNullSafe(looked_up)).count() == 0
    assert df.filter(~strip_accents("t").eqNullSafe(F.translate("t", ACCENTED, PLAIN))).count() == 0
