"""Ranked lexical search, in which documents of equal bags of terms are scored once."""

from __future__ import annotations

import math
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from peneira.llm.common import stored, texts_of

TOP = 20
BLOCK_TERMS = 500_000  # terms of the items that are searched for in one pass
COMMON = 64  # the terms of most items, whose scores are one matrix product
CELLS = 4 << 20  # scores that are computed at a time: classes x items
SCALE, B = 1_000_000_000, 25  # of the score's whole numbers; the share of a document's length, in hundredths

_KEPT = (string.ascii_letters + string.digits).encode()
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or c in _KEPT else 32 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """The maximal stretches of ASCII letters, digits and other characters beyond ASCII; A-Z lower-cased."""
    return text.translate(_TABLE).split()


def _item_blocks(items: DataFrame, item_id: str, text: str, block_terms: int) -> Iterator[list[tuple[object, dict[bytes, int]]]]:
    """The items with their terms' counts, in blocks of about ``block_terms`` counts.

    Each block is on the driver by itself; an item is never cut.
    """
    rows = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([len(set(terms_of(t))) for t in texts_of(batch.column(1))], pa.int64())],
                names=["item_id", "text", "size"],
            )

    sized = stored(rows.mapInArrow(work, StructType([*rows.schema.fields]).add("size", "long")).filter("size > 0"), "items")
    blocks = max(1, math.ceil((sized.agg(F.sum("size")).first()[0] or 0) / block_terms))
    for block in range(blocks):
        mine = sized.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        found: list[tuple[object, dict[bytes, int]]] = []
        for r in mine.select("item_id", F.col("text").cast("binary").alias("text")).toLocalIterator():
            counts: dict[bytes, int] = {}
            for term in terms_of(bytes(r.text)):
                counts[term] = counts.get(term, 0) + 1
            found.append((r.item_id, counts))
        if found:
            yield found


def _bags(docs: DataFrame, doc_id: str, text: str, vocabulary: list[bytes]) -> DataFrame:
    """``doc_id``, ``n`` and the bag of every document that has a term: how often each term of the vocabulary
    occurs, as pairs of 32-bit numbers (term, times), by term."""
    shared = docs.sparkSession.sparkContext.broadcast({term: k for k, term in enumerate(vocabulary)})
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for batch in batches:
            sizes, bags = [], []
            for raw in texts_of(batch.column(1)):
                terms = terms_of(raw)
                own = np.fromiter((k for k in map(number, terms) if k is not None), np.int64)
                kinds, times = np.unique(own, return_counts=True)
                sizes.append(len(terms))
                bags.append(np.stack([kinds, times], axis=1).astype("<u4").tobytes())
            found = pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(bags, pa.binary())], names=["doc_id", "n", "bag"]
            )
            yield found.filter(pa.array(np.array(sizes) > 0))

    schema = StructType([rows.schema["doc_id"]]).add("n", "long").add("bag", "binary")
    return rows.mapInArrow(work, schema)


def _document_counts(bags: DataFrame, size: int) -> np.ndarray:
    """In how many documents each term occurs: a number for each term from each task, added up."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            pairs = np.frombuffer(b"".join(batch.column(0).to_pylist()), "<u4").reshape(-1, 2)
            total += np.bincount(pairs[:, 0], minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["term", "df"])

    counts = bags.select("bag").mapInArrow(work, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    result = np.zeros(size, np.int64)
    result[counts.column("term").to_numpy()] = counts.column("df").to_numpy()
    return result


def classes_of(bags: DataFrame, documents: int, terms: int, top: int = TOP) -> DataFrame:
    """``bag``, ``m`` and ``members`` of every class of documents with the same bag and m.

    Bags and m are hashed, and documents of one hash compared in full, as grouping by all three does. All
    documents of a class have the same score, so that no more than its ``top`` smallest ids can be in a
    result: ``members`` are those, ascending, nulls last, repeated ids as often as they occur. Tasks
    leave out the others before the shuffle, so that a class of very many documents is no burden.
    """
    m = F.expr(f"CAST({100 - B} + ({B} * n * CAST({documents} AS BIGINT)) DIV {max(terms, 1)} AS BIGINT)")
    rows = bags.filter(F.length("bag") > 0).select("doc_id", "bag", m.alias("m"))
    rows = rows.withColumn("hash", F.xxhash64("bag", "m"))
    place = F.row_number().over(Window.partitionBy("hash", "bag", "m").orderBy(F.asc_nulls_last("doc_id")))
    first = rows.withColumn("place", place).filter(F.col("place") <= top)
    member = F.collect_list(F.struct("place", "doc_id"))
    grouped = first.groupBy("hash", "bag", "m").agg(F.array_sort(member).alias("members"))
    return grouped.select("bag", "m", F.col("members.doc_id").alias("members"))


class _Scorer:
    """The items' weights: a row for each term, a column for each item; the commonest terms' rows as a matrix."""

    def __init__(self, starts: np.ndarray, items: np.ndarray, weights: np.ndarray, n_items: int):
        self.starts, self.items, self.weights, self.n_items = starts, items, weights, n_items
        spread = np.diff(starts)
        self.common = np.argsort(-spread, kind="stable")[:COMMON]
        self.row = np.full(len(spread), -1)
        self.row[self.common] = np.arange(len(self.common))
        # Sums below 2**53 are exact in floats, which are added faster; an item of very many terms takes whole numbers.
        most = np.bincount(items, weights, n_items).max(initial=0)
        self.kind = np.float64 if most * (SCALE // 1000) < 2**53 else np.int64
        self.matrix = np.zeros((len(self.common), n_items), self.kind)
        for k, term in enumerate(self.common.tolist()):
            own = slice(starts[term], starts[term + 1])
            self.matrix[k, items[own]] = weights[own]

    def scores(self, owner: np.ndarray, terms: np.ndarray, times: np.ndarray, m: np.ndarray) -> np.ndarray:
        """Of every class with every item, exactly."""
        impact = SCALE * times // (1000 * times + 12 * m[owner])
        row = self.row[terms]
        often = row >= 0
        left = np.zeros((len(m), len(self.common)), self.kind)
        left[owner[often], row[often]] = impact[often]
        total = left @ self.matrix
        owner, terms, impact = owner[~often], terms[~often], impact[~often]
        spread = self.starts[terms + 1] - self.starts[terms]
        which = np.repeat(np.arange(len(terms)), spread)
        at = np.arange(len(which)) - np.repeat(np.cumsum(spread) - spread, spread) + self.starts[terms][which]
        cells = owner[which] * self.n_items + self.items[at]
        if self.kind is np.float64:
            total += np.bincount(cells, impact[which] * self.weights[at], total.size).reshape(total.shape)
        else:
            np.add.at(total.reshape(-1), cells, impact[which] * self.weights[at])
        return total


def _best(scorer: _Scorer, rows: DataFrame, top: int) -> DataFrame:
    """For every item the best documents of each task, as ``item``, ``doc_id`` and ``score``."""
    shared = rows.sparkSession.sparkContext.broadcast((scorer.starts, scorer.items, scorer.weights, scorer.n_items))

    def ranked(item, score, classes, lists) -> tuple:
        """The best classes of each item by score, then by their first document's id."""
        first = lists.values.take(pa.array(lists.offsets.to_numpy()[:-1][classes]))
        order = pc.sort_indices(
            pa.table({"item": item, "score": score, "id": first}),
            sort_keys=[("item", "ascending"), ("score", "descending"), ("id", "ascending")],
            null_placement="at_end",
        ).to_numpy()
        start = np.searchsorted(item[order], item[order])
        order = order[np.arange(len(order)) - start < top]
        return item[order], score[order], classes[order]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _Scorer(*shared.value)
        step = max(1, CELLS // own.n_items)
        held = None  # items, scores and members of the best classes so far
        for batch in batches:
            for low in range(0, batch.num_rows, step):
                some = batch.slice(low, step)
                raw = some.column(0).to_pylist()
                pairs = np.frombuffer(b"".join(raw), "<u4").reshape(-1, 2).astype(np.int64)
                owner = np.repeat(np.arange(len(raw)), [len(b) // 8 for b in raw])
                m = some.column(1).to_numpy()
                total = own.scores(owner, pairs[:, 0], pairs[:, 1], m)
                if len(raw) > top:  # nothing below an item's top-th score in this run
                    least = np.partition(total, len(raw) - top, axis=0)[len(raw) - top]
                    hits = np.nonzero((total > 0) & (total >= least))
                else:
                    hits = np.nonzero(total > 0)
                lists, classes, item, score = some.column(2), hits[0], hits[1], total[hits].astype(np.int64)
                if held is not None:
                    lists = pa.concat_arrays([held[2], lists])
                    classes = np.concatenate([np.arange(len(held[0])), classes + len(held[0])])
                    item, score = np.concatenate([held[0], item]), np.concatenate([held[1], score])
                item, score, classes = ranked(item, score, classes, lists)
                held = item, score, lists.take(pa.array(classes))
        if held is not None and len(held[0]):
            counts = np.diff(held[2].offsets.to_numpy())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(held[0], counts)), held[2].flatten(), pa.array(np.repeat(held[1], counts))],
                names=["item", "doc_id", "score"],
            )

    schema = StructType().add("item", "long").add("doc_id", rows.schema["members"].dataType.elementType).add("score", "long")
    return rows.mapInArrow(work, schema)


def search(
    docs: DataFrame,
    items: DataFrame,
    top: int = TOP,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score``: the ``top`` best documents for each item, all rows searched.

    Scores are whole numbers, after BM25: with N documents of at least one term, L terms in all of them,
    n in one, df documents that hold a term and tf of its occurrences in one,
    w = floor(1000 ln((2 N + 2) / (2 df + 1))), m = 75 + (25 n N) div L, a document's score is the sum
    of w * ((10^9 tf) div (1000 tf + 12 m)) over the item's terms, repeats included. Documents that score 0 or
    less are left out; equal scores go by ascending id, null ids last.

    Null and empty texts, and those without a term, are found by nothing and find nothing. A text is read
    whole, however long. Repeated rows are documents of their own, and repeated items are searched for again,
    each with ranks from 1. No rows on either side give no rows. Other columns are not read, so their names
    do not matter.

    Documents are read once for each block of items (``block_terms`` bounds what a block broadcasts),
    and their bags, restricted to the items' terms, are stored. Of a class of equal bags and m one
    is scored, in the task that has the class; each task gives on its best for every item, and Spark merges those.
    """
    spark = docs.sparkSession
    id_kind, item_kind = docs.schema[doc_id].dataType, items.schema[item_id].dataType
    result = spark.createDataFrame([], StructType().add("item_id", item_kind).add("rank", "integer").add("doc_id", id_kind).add("score", "long"))
    for block in _item_blocks(items, item_id, item_text, block_terms):
        vocabulary = sorted({term for _, counts in block for term in counts})
        number = {term: k for k, term in enumerate(vocabulary)}
        bags = stored(_bags(docs, doc_id, text, vocabulary), "bags")
        documents, terms = bags.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = _document_counts(bags, len(vocabulary))
        weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(d) + 1))) for d in df], np.int64)
        entries = np.array([(number[t], i, c) for i, (_, counts) in enumerate(block) for t, c in counts.items()], np.int64)
        entries = entries[np.argsort(entries[:, 0], kind="stable")]
        starts = np.searchsorted(entries[:, 0], np.arange(len(vocabulary) + 1))
        scorer = _Scorer(starts, entries[:, 1], weight[entries[:, 0]] * entries[:, 2], len(block))
        best = _best(scorer, classes_of(bags, documents, terms, top), top)
        place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
        ranked = best.withColumn("rank", place).filter(F.col("rank") <= top)
        names = spark.createDataFrame([(i, name) for i, (name, _) in enumerate(block)], StructType().add("item", "long").add("item_id", item_kind))
        result = result.union(ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    return result
