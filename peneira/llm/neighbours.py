"""Exact nearest neighbours by a block matrix join over quantised tiles."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peneira.llm.common import partitions, stored

TILE = 4096  # vectors of a tile
GROUP_TILES = 16  # candidate tiles that a query tile meets in one task
STEP = 256  # queries whose products with a tile are held at a time
TINY = 1e-290  # beyond what is lost where products are too small for double precision
EXACT_DIMS = 1024  # products of so many 8-bit numbers add up exactly in single precision

TILES = "dim int, is_query boolean, tile long, n int, ids binary, vectors binary"


def usable(vector: Column) -> Column:
    """Vectors that take part: not null, no null or non-finite component, not all zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def _tiles(rows: DataFrame, kind: type) -> DataFrame:
    """The rows packed into matrices of at most ``TILE`` rows, as they are read: no key decides where a row goes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        held: dict[tuple[int, bool], list[tuple[np.ndarray, np.ndarray]]] = {}
        sizes: dict[tuple[int, bool], int] = {}

        def tiles(key: tuple[int, bool], least: int) -> Iterator[pa.RecordBatch]:
            nonlocal number
            ids = np.concatenate([i for i, _ in held[key]])
            vectors = np.concatenate([v for _, v in held[key]])
            at = 0
            while len(ids) - at >= least:
                i, v = ids[at : at + TILE], vectors[at : at + TILE]
                yield pa.RecordBatch.from_pydict(
                    {
                        "dim": pa.array([key[0]], pa.int32()),
                        "is_query": [key[1]],
                        "tile": pa.array([(part << 32) + number], pa.int64()),
                        "n": pa.array([len(i)], pa.int32()),
                        "ids": pa.array([i.tobytes()], pa.binary()),
                        "vectors": pa.array([v.tobytes()], pa.binary()),
                    }
                )
                number, at = number + 1, at + TILE
            held[key] = [(ids[at:], vectors[at:])]
            sizes[key] = max(len(ids) - at, 0)

        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            dims, queries = batch.column(2).to_numpy(), batch.column(3).to_numpy(zero_copy_only=False)
            lists = batch.column(1)
            ends = np.cumsum(dims.astype(np.int64))
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
            for dim in np.unique(dims).tolist():
                own = dims == dim
                matrix = flat[np.repeat(own, dims)].reshape(-1, dim) if len(ends) else flat.reshape(0, dim)
                for is_query in (False, True):
                    chosen = queries[own] if is_query else np.ones(int(own.sum()), bool)
                    if chosen.any():
                        key = (dim, is_query)
                        held.setdefault(key, []).append((ids[own][chosen].astype(np.int64), matrix[chosen]))
                        sizes[key] = sizes.get(key, 0) + int(chosen.sum())
                        if sizes[key] >= TILE:
                            yield from tiles(key, TILE)
        for key in sorted(held):
            if sizes[key]:
                yield from tiles(key, 1)

    return stored(rows.mapInArrow(work, TILES), "tiles")


class Quantised:
    """A matrix as 8-bit integers with a scale for each row, and the norms that bound the error."""

    def __init__(self, vectors: np.ndarray):
        wide = vectors.astype(np.float64)
        self.scale = np.abs(wide).max(axis=1) / 127
        with np.errstate(all="ignore"):  # beyond double precision the bounds are not finite
            ratio = np.rint(wide / self.scale[:, None])
            self.small = np.where(np.isfinite(ratio), np.clip(ratio, -127, 127), 0).astype(np.int8)
            rounded = self.small * self.scale[:, None]
            self.norm = np.sqrt((rounded**2).sum(axis=1))
            self.error = np.sqrt(((wide - rounded) ** 2).sum(axis=1))

    def times(self, other: Quantised, rows: slice) -> np.ndarray:
        """Inner products of the rounded vectors: sums of 8-bit products, exact, then scaled."""
        total = np.zeros((len(self.small[rows]), len(other.small)))
        for k in range(0, self.small.shape[1], EXACT_DIMS):
            left = self.small[rows, k : k + EXACT_DIMS].astype(np.float32)
            total += left @ other.small[:, k : k + EXACT_DIMS].astype(np.float32).T
        with np.errstate(all="ignore"):
            return total * self.scale[rows, None] * other.scale[None, :]

    def slack(self, other: Quantised, rows: slice) -> np.ndarray:
        """How far a true inner product may be from that of the rounded vectors.

        With x = a + e and y = b + f, xy - ab = af + eb + ef, each bounded by its norms.
        """
        norm, error = self.norm[rows, None], self.error[rows, None]
        with np.errstate(all="ignore"):
            bound = norm * other.error + error * other.norm + error * other.error
            return bound + 1e-9 * (norm * other.norm + bound) + TINY  # the rounding of these very sums


def inner_products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """In double precision, added component by component in order, so that equal vectors score alike wherever they are."""
    total = np.zeros(len(vectors))
    with np.errstate(all="ignore"):
        for column, x in zip(vectors.T, query, strict=True):
            total += column * x
    return total


def _merge(best: dict[int, float], found: Iterator[tuple[int, float]], k: int) -> dict[int, float]:
    """The k best of both; an id that occurs more than once keeps its best score."""
    for i, score in found:
        if i not in best or score > best[i]:
            best[i] = score
    if len(best) <= k:
        return best
    return dict(heapq.nsmallest(k, best.items(), key=lambda x: (-x[1], x[0])))


def nearest_in_tile(
    best: list[dict[int, float]], query_ids: np.ndarray, queries: np.ndarray, left: Quantised,
    ids: np.ndarray, vectors: np.ndarray, right: Quantised, k: int,
) -> None:
    """Adds a candidate tile's nearest to the best so far of each query.

    Bounds from the quantised products tell which candidates may be among the k nearest: those whose
    upper bound reaches the k-th largest lower bound, or the k-th score so far. Those alone
    are computed in double precision from the original vectors.
    """
    wide = vectors.astype(np.float64)
    repeated = len(np.unique(ids)) < len(ids)
    for start in range(0, len(queries), STEP):
        rows = slice(start, start + STEP)
        product, slack = left.times(right, rows), left.slack(right, rows)
        other = query_ids[rows, None] != ids[None, :]
        with np.errstate(all="ignore"):
            low, high = product - slack, product + slack
        unsure = ~(np.isfinite(low) & np.isfinite(high))  # no bound: such a pair is always computed
        low[unsure | ~other] = -np.inf
        floor = np.array([min(b.values()) if len(b) >= k else -np.inf for b in best[rows]])
        if len(ids) > k and not repeated:
            floor = np.maximum(floor, np.partition(low, -k, axis=1)[:, -k])
        able = ((high >= floor[:, None]) | unsure) & other
        for n, chosen in enumerate(able):
            at = np.flatnonzero(chosen)
            if len(at):
                scores = inner_products(wide[at], queries[start + n].astype(np.float64))
                sure = ~np.isnan(scores)  # both infinities among the products: not a number
                at, scores = at[sure], scores[sure]
                if len(at) > k and not repeated:
                    last = np.partition(scores, -k)[-k]
                    at, scores = at[scores >= last], scores[scores >= last]
                best[start + n] = _merge(best[start + n], zip(ids[at].tolist(), scores.tolist(), strict=True), k)


def nearest(
    rows: DataFrame, vec_id: str, vector: str, is_query: Column, k: int = 20, tile_rows: int = TILE
) -> DataFrame:
    """The k nearest of each query by inner product: ``query_id``, ``rank``, ``vec_id``, ``score``.

    Exact: every candidate of the query's dimension is scored or shown by its bound to be too far.
    Rank counts from 1; equal scores go to the smaller id; a query is no neighbour of its own id.
    Vectors that are null, all zero, or hold null or non-finite components take no part,
    nor do rows with a null id. Fully repeated rows count once; an id with several
    vectors is represented by the best of them. Fewer than k candidates give fewer rows. Sums beyond
    double precision are infinite and rank first, or last if negative; a pair whose sum is not a number, of two
    infinities, is left out. Other columns are not looked at.

    The rows are packed into matrix tiles; each query tile meets groups of candidate tiles, each
    group in one task. Candidate tiles are shuffled once, query tiles once for each group.
    """
    spark = rows.sparkSession
    kind = np.float32 if "float" in rows.schema[vector].dataType.simpleString() else np.float64
    element = "float" if kind is np.float32 else "double"
    chosen = rows.select(
        F.col(vec_id).cast("long").alias("id"),
        F.col(vector).cast(f"array<{element}>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"),
    ).filter(usable(F.col("vector")) & F.col("id").isNotNull())
    chosen = chosen.dropDuplicates(["id", "vector"]).select("id", "vector", F.size("vector").alias("dim"), "is_query")
    tiles = _tiles(chosen, kind)
    number = tiles.filter("not is_query").count()
    groups = max(-(-number // GROUP_TILES), min(number, partitions(spark)), 1)
    candidates = tiles.filter("not is_query").select(
        "dim", F.pmod(F.xxhash64("tile"), F.lit(groups)).alias("group"), "tile", "ids", "vectors"
    )
    queries = tiles.filter("is_query").select(
        "dim",
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("group"),
        F.col("tile").alias("query_tile"),
        F.col("ids").alias("query_ids"),
        F.col("vectors").alias("queries"),
    )
    pairs = queries.join(candidates, ["dim", "group"]).select("dim", "query_tile", "query_ids", "queries", "ids", "vectors")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, queries, left = None, np.zeros(0, np.int64), np.zeros((0, 1)), None
        best: list[dict[int, float]] = []

        def results() -> pa.RecordBatch:
            found = [(int(q), i, s) for q, b in zip(ids, best, strict=True) for i, s in b.items()]
            a, b, c = zip(*found, strict=True) if found else ([], [], [])
            return pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.float64())],
                names=["query_id", "vec_id", "score"],
            )

        for batch in batches:
            for n in range(batch.num_rows):
                dim, tile, q_ids, q, c_ids, c = (column[n].as_py() for column in batch.columns)
                if tile != at:
                    if best:
                        yield results()
                    at, ids = tile, np.frombuffer(q_ids, np.int64)
                    queries = np.frombuffer(q, kind).reshape(-1, dim)
                    left, best = Quantised(queries), [{} for _ in ids]
                vectors = np.frombuffer(c, kind).reshape(-1, dim)
                nearest_in_tile(
                    best, ids, queries, left, np.frombuffer(c_ids, np.int64), vectors, Quantised(vectors), k
                )
        if best:
            yield results()

    partial = pairs.mapInArrow(work, "query_id long, vec_id long, score double")
    one = partial.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = one.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
