"""Small known results: late flights, a poem, padded cities, the states of Brazil."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from peneira.functions.predicates import equals_standardised, equals_trimmed, keep_listed
from peneira.functions.text import standardise
from peneira.operators.aggregates import count_per_key, sum_per_key, summary_per_key
from peneira.operators.combine import co_group, flatten
from peneira.operators.projections import explode_tokens
from peneira.operators.python_functions import combine_per_key, for_each_record
from peneira.sources import inline_rows, read_csv, read_lines, split_fields

# Origin, destination and arrival delay of the 20 sample flights, in order.
FLIGHTS = """
JFK LAX 2, LAX JFK -29, JFK LAX 39, LAX JFK -27, DFW HNL 15, OGG DFW 95, DFW OGG 138, HNL DFW -22,
JFK LAX 19, LAX JFK 1, LAX JFK -40, OGG LAX -17, BOS ORD -19, SFO JFK -33, ATL MIA -17, SFO JFK 88,
JFK LAX 18, SFO JFK 120, JFK LAX 16, LAX JFK 11
"""
# The sample poem, blanks included.
POEM = (
    "Há quatro quadros três e três quadros quatro. \n"
    "Sendo que quatro destes quadros são quadrados,\n"
    " um dos quadros quatro e três dos quadros três.\n"
    " Os três quadros que não são quadrados,\n"
    " são dois dos quadros quatro e um dos quadros três."
)
LATE = {"DFW": 95, "HNL": 15, "JFK": 220, "LAX": 94, "OGG": 138}
NAMES = ["origin", "destination", "delay"]


@pytest.fixture
def flights_file(folder) -> str:
    path = os.path.join(folder, "flights.csv")
    lines = [",".join(flight.split()) for flight in FLIGHTS.replace("\n", " ").split(",")]
    with open(path, "w") as file:
        file.write("\n".join(lines))
    return path


@pytest.fixture
def poem(spark, folder):
    with open(os.path.join(folder, "poem.txt"), "w", encoding="utf-8") as file:
        file.write(POEM)
    return read_lines(spark, folder)


def pairs(df) -> dict:
    return {r[0]: r[1] for r in df.collect()}


def flights(spark, path, header):
    return read_csv(spark, path, header=header, schema="origin string, destination string, delay int")


def test_late_minutes(spark, flights_file):
    rows = read_lines(spark, flights_file).select(*split_fields("value", ",", NAMES))
    late = rows.withColumn("delay", F.col("delay").cast("int")).filter("delay > 0")
    assert pairs(sum_per_key(late, "destination", "delay")) == LATE
    assert pairs(combine_per_key(late, "destination", "delay", sum)) == LATE


def test_late_minutes_and_flights_when_the_first_line_is_skipped(spark, flights_file):
    rows = read_lines(spark, flights_file, skip=1).select(*split_fields("value", ",", NAMES))
    late = rows.withColumn("delay", F.col("delay").cast("int")).filter("delay > 0")
    sums = sum_per_key(late, "destination", "delay")
    counts = count_per_key(late, "destination")
    assert pairs(sums) == {**LATE, "LAX": 92}
    assert pairs(counts) == {"DFW": 1, "HNL": 1, "JFK": 4, "LAX": 4, "OGG": 1}
    named = lambda df: df.toDF("key", "value")
    grouped = co_group({"counts": named(counts), "sums": named(sums)}, 100).collect()
    assert {r.key: (r.counts, r.sums) for r in grouped}["JFK"] == ([4], [220])
    assert len(grouped) == 5
    together = summary_per_key(late, "destination", "delay")
    assert {r[0]: (r[1], r[2]) for r in together.collect()}["JFK"] == (4, 220)


def test_records_by_a_class(spark, flights_file):
    class Late:
        def process(self, record):
            if int(record[2]) > 0:
                return [record]

    rows = read_lines(spark, flights_file, skip=1).select(*split_fields("value", ",", NAMES))
    late = for_each_record(rows, Late().process, "origin string, destination string, delay string")
    assert late.count() == 11


def test_flights_from_one_origin(spark, flights_file):
    assert read_lines(spark, flights_file).count() == 20
    rows = read_lines(spark, flights_file, skip=1).select(*split_fields("value", ",", NAMES))
    assert rows.filter(F.col("origin") == "LAX").count() == 5
    assert flights(spark, flights_file, False).filter(F.col("origin") == "LAX").count() == 5


def test_poem(spark, poem):
    assert poem.count() == 5
    words = explode_tokens(poem, "value")
    assert words.count() == 45
    assert words.filter(F.col("token") == "").count() == 4
    found = keep_listed(words, "token", ["quatro", "um"])
    assert pairs(count_per_key(found, "token")) == {"quatro": 4, "um": 2}


def test_flatten_three_lists(spark):
    lists = [inline_rows(spark, [(f"{g}{i}",) for i in range(3)], "name string") for g in "abc"]
    assert flatten(lists).count() == 9


def test_padded_cities(spark):
    cities = ["Belo Horizonte ", " Belo Horizonte ", "Rio de Janeiro", " Belo Horizonte", "Brasília"]
    rows = inline_rows(spark, [(c,) for c in cities], "cidade string")
    name = "Belo Horizonte"
    found = [
        rows.filter(F.col("cidade") == name).count(),
        *[rows.filter(equals_trimmed("cidade", name, side)).count() for side in ("right", "left", "both")],
    ]
    assert found == [0, 1, 1, 3]


def test_states(spark):
    names = ["São Paulo", "Maranhão", "Amapá", "Paraná", "Pará", "Goiás", "Piauí", "Mato Grosso"]
    rows = inline_rows(spark, [(n,) for n in names], "estado string").withColumn("simples", standardise("estado"))
    assert rows.filter(F.col("simples") == "sao paulo").count() == 1
    assert rows.filter(F.col("simples") == "Maranhao").count() == 0
    assert rows.filter(equals_standardised("estado", "MARANHÃO")).count() == 1
