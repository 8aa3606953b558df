from __future__ import annotations

import numpy as np
import pytest
from conftest import bag
from pyspark.sql import functions as F

from compare import connect, duck_bag, spark_bag
from peneira.llm import neighbours, queries


def brute(vectors: list[tuple[int, list[float]]], k: int) -> list[tuple]:
    rows = sorted({(i, tuple(v)) for i, v in vectors})
    result = []
    for query in sorted({i for i, _ in rows if i % 20 == 0}):
        best: dict[int, float] = {}
        for own in (v for i, v in rows if i == query):
            for i, v in rows:
                if i != query and len(v) == len(own):
                    score = 0.0
                    for a, b in zip(v, own, strict=True):
                        score += a * b
                    best[i] = max(best.get(i, -np.inf), score)
        ranked = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
        result += [(query, rank, i, score) for rank, (i, score) in enumerate(ranked, 1)]
    return result


def nearest(df, k=20):
    return neighbours.nearest(df, "vec_id", "embedding", F.col("vec_id") % 20 == 0, k)


@pytest.fixture(scope="module")
def vectors():
    dice = np.random.default_rng(3)
    rows = [(i, dice.normal(size=24).astype(np.float32).tolist()) for i in range(400)]
    same = dice.normal(size=24).astype(np.float32).tolist()
    rows += [(i, same) for i in range(400, 600)]  # a third of all rows has one vector
    rows += [(600, rows[3][1]), (600, rows[3][1]), (601, rows[5][1]), (601, rows[6][1]), (620, rows[7][1]), (620, rows[8][1])]
    rows += [(640, [1.0, 2.0]), (641, [3.0, 4.0])]  # another dimension
    return [(i, [float(x) for x in v]) for i, v in rows]


@pytest.mark.parametrize("tile", [4096, 64])
def test_all_neighbours_are_exact(spark, vectors, tile, monkeypatch):
    monkeypatch.setattr(neighbours, "TILE", tile)
    monkeypatch.setattr(neighbours, "GROUP_TILES", 3)
    df = spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>").repartition(5)
    assert bag(nearest(df)) == sorted(brute(vectors, 20), key=repr)
    wide = df.withColumns({"rank": F.lit("x"), "score": F.lit("y"), "group": F.lit(1), "id": F.lit(0)})
    assert bag(nearest(wide, 3)) == sorted(brute(vectors, 3), key=repr)


def test_doubles(spark, vectors):
    dice = np.random.default_rng(4)
    rows = [(i, dice.normal(size=7).tolist()) for i in range(90)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert bag(nearest(df)) == sorted(brute(rows, 20), key=repr)


def test_unusable_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 1.0]), (2, None), (3, [0.0, -0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]),
            (6, [None, 1.0]), (20, []), (40, [0.0, 0.0]), (None, [9.0, 9.0]), (7, [-1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    assert bag(nearest(df)) == [(0, 1, 1, 2.0), (0, 2, 7, -1.0)]
    assert nearest(df.limit(0)).count() == 0


def test_bounds_hold():
    dice = np.random.default_rng(5)
    x, y = dice.normal(size=(40, 2000)) * 10 ** dice.uniform(-3, 3, (40, 1)), dice.normal(size=(50, 2000))
    a, b = neighbours.Quantised(x), neighbours.Quantised(y)
    rows = slice(0, 40)
    gap = np.abs(x @ y.T - a.times(b, rows))
    assert (gap <= a.slack(b, rows)).all()
    assert (a.slack(b, rows) < 0.04 * a.norm[:, None] * b.norm).all()


def test_inner_products_beyond_double_precision(spark):
    dice = np.random.default_rng(6)
    rows = []
    for i in range(120):
        vector = dice.normal(size=6) * 10.0 ** [200, 0, 150, -160][i // 20 % 4]
        rows.append((i, (np.abs(vector) if i % 3 == 0 else vector).tolist()))
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(4)
    with np.errstate(all="ignore"):
        scores = {(q, i): sum((np.float64(a) * b for a, b in zip(x, y, strict=True)), np.float64(0)) for q, x in rows if q % 20 == 0 for i, y in rows if i != q}
    expected = []
    for query in range(0, 120, 20):
        ranked = sorted(((-s, i) for (q, i), s in scores.items() if q == query and not np.isnan(s)))[:20]
        expected += [(query, rank, i, float(-s)) for rank, (s, i) in enumerate(ranked, 1)]
    assert any(np.isinf(s) for *_, s in expected) and any(np.isfinite(s) for *_, s in expected)
    assert bag(nearest(df)) == sorted(expected, key=repr)


def test_same_as_sql(spark, sf_dir):
    found = spark_bag(queries.op4_nearest(spark, sf_dir))
    assert found == duck_bag(connect(sf_dir), queries.ORACLE_SQL["op4_nearest"])
    assert sum(found[1].values()) > 0
