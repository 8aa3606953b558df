"""Near duplicates by SimHash fingerprints and covering locality-sensitive hashing."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from peneira.llm.common import partitions, per_batch, sorted_groups, stored, texts_of
from peneira.llm.components import least_reachable

SHINGLE_WORDS = 4
MAX_BITS = 4
HASH_SEED = 42
BITS = 64
CHUNK = 4096  # fingerprints of a table's bucket that are compared in one task


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """SimHash of a text: bit i is set if it is set in over half of the shingles' hashes.

    Shingles are ``words`` neighbouring words (the whole sequence if there are fewer),
    repeats included. ``bytes.lower`` changes A-Z alone, ``bytes.split`` cuts at
    U+0020 and U+0009 to U+000D alone.
    """
    parts = text.lower().split()
    if not parts:
        return 0
    line = b" ".join(parts)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
    ends = np.cumsum(sizes)
    starts, ends = (ends - sizes).tolist(), (ends - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = [digest(line[a:b], HASH_SEED) for a, b in zip(starts, ends[words - 1 :] or ends[-1:], strict=False)]
    counts = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), 1 << 16):
        some = np.array(hashes[k : k + (1 << 16)], dtype=">u8")
        counts += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big")


def with_fingerprints(docs: DataFrame, doc_id: str, text: str, words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id`` and ``fp`` (the fingerprint as a signed long) of every row."""
    kind = docs.schema[doc_id].dataType.simpleString()
    ids = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]

    def work(batch: pa.RecordBatch) -> dict:
        fps = np.array([fingerprint(t, words) for t in texts_of(batch.column(1))], np.uint64)
        return {"doc_id": batch.column(0), "fp": fps.view(np.int64)}

    schema = pa.schema([("doc_id", ids), ("fp", pa.int64())])
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(per_batch(work, schema), f"doc_id {kind}, fp bigint")


def covering_masks(radius: int = MAX_BITS, bits: int = BITS) -> list[int]:
    """Masks such that any two values within ``radius`` bits agree under one of them.

    Every bit position gets a non-zero vector of radius + 1 binary digits; mask m
    has the positions whose vector has an odd inner product with m. The vectors
    of at most ``radius`` differing positions do not span the whole space, so some
    m is orthogonal to all of them, and its mask has none of those positions.
    """
    size = 1 << (radius + 1)
    vectors = [i % (size - 1) + 1 for i in range(bits)]
    return [sum(1 << i for i, v in enumerate(vectors) if (v & m).bit_count() % 2) for m in range(1, size)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def spanning_links(values: np.ndarray, radius: int) -> tuple[list[int], list[int]]:
    """Links within the radius that connect whatever all such links would connect.

    A search from value to value: each value is compared only with those not yet
    reached, so a dense group costs about one comparison a value, and at most one
    link a value results.
    """
    left, right = [], []
    rest = np.arange(len(values))
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            near = np.bitwise_count(values[rest] ^ values[at]) <= radius
            found = rest[near]
            if len(found):
                rest = rest[~near]
                left += [at] * len(found)
                right += found.tolist()
                queue += found.tolist()
    return left, right


def close_fingerprints(fps: DataFrame, radius: int = MAX_BITS, chunk: int = CHUNK) -> DataFrame:
    """Links (``a``, ``b``) that connect all distinct values of ``fp`` within ``radius`` bits.

    Each value is put in one bucket of each covering table. Buckets are counted
    first: one of two values is a pair; in larger ones, values are cut by hash into
    chunks, and each two chunks meet in a task of their own, so a bucket of any size
    is compared by many tasks of bounded size. Only links that connect are
    returned, never all pairs of a bucket.

    Spark sizes rows after ``explode`` as those before it, here 31 times too low, so the join
    says that neither side is to be broadcast.
    """
    keys = [
        F.xxhash64(F.lit(t), F.col("fp").bitwiseAND(F.lit(_signed(mask))))
        for t, mask in enumerate(covering_masks(radius))
    ]
    placed = fps.select(F.explode(F.array(*keys)).alias("bucket"), "fp")
    buckets = (
        placed.groupBy("bucket")
        .agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
        .filter("n > 1")
    )
    pairs = buckets.filter("n = 2").select("a", "b").filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)
    many = buckets.filter("n > 2").select("bucket", F.ceil(F.col("n") / chunk).cast("int").alias("chunks"))
    own = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("chunks")).cast("int")
    blocks = (
        placed.join(many.hint("merge"), "bucket")
        .select("bucket", "fp", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
        .select("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp")
        .repartition(partitions(fps.sparkSession), "bucket", "i", "j")
        .sortWithinPartitions("bucket", "i", "j", "fp")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = [], []
        for group in sorted_groups(batches, ["bucket", "i", "j"]):
            values = group.column("fp").to_numpy()
            a, b = spanning_links(values.view(np.uint64), radius)
            if a:
                left.append(values[a])
                right.append(values[b])
            if sum(map(len, left)) > 1 << 18:
                yield pa.RecordBatch.from_pydict({"a": np.concatenate(left), "b": np.concatenate(right)})
                left, right = [], []
        if left:
            yield pa.RecordBatch.from_pydict({"a": np.concatenate(left), "b": np.concatenate(right)})

    return pairs.union(blocks.mapInArrow(compare, "a bigint, b bigint")).distinct()


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS, radius: int = MAX_BITS
) -> DataFrame:
    """Every row's ``doc_id``, ``fp``, and ``component_id``: the smallest id reachable over links.

    Two rows are linked if their fingerprints differ in at most ``radius`` bits.
    Equal fingerprints are one node from the start, so copies add no links.
    Null and blank texts have fingerprint zero and are linked like others. A null
    id is never a ``component_id`` unless all ids of the component are null.
    Repeated rows stay repeated. Other columns are ignored.
    """
    rows = stored(with_fingerprints(docs, doc_id, text, words), "fingerprints")
    fps = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    reached = least_reachable(close_fingerprints(fps.select("fp"), radius))
    # The least node of a component has no row of its own.
    labels = reached.select(F.col("node").alias("fp"), "least").union(
        reached.select(F.col("least").alias("fp"), "least").distinct()
    )
    linked = labels.join(fps, "fp")
    ids = linked.groupBy("least").agg(F.min("first_id").alias("component_id"))
    components = linked.join(ids, "least").select("fp", "component_id")
    # Stored, so that both sides of the last join are shuffled anew and a frequent fingerprint can be split.
    known = fps.join(components, "fp", "left").select(
        "fp", F.coalesce("component_id", "first_id").alias("component_id")
    )
    known = stored(known, "components")
    return rows.join(known, "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` whose id is that of their component, one row each; all rows with a null id.

    Of several rows with one id that stays whose text has the least hash, then the least hash of all plain columns,
    so that another run keeps the same. Texts are whole, null and blank ones near duplicates of each other;
    columns keep their names and order, whatever they are called. No rows give no rows.
    """
    found = near_duplicates(docs, doc_id, text, **how)
    ids = f"kept_{uuid.uuid4().hex}"
    kept = found.filter("doc_id = component_id").select(F.col("doc_id").alias(ids)).distinct()
    plain = [f"`{f.name}`" for f in docs.schema if isinstance(f.dataType, AtomicType)]
    order = Window.partitionBy(doc_id).orderBy(F.xxhash64(text), F.xxhash64(*plain))
    one = docs.join(kept, F.col(doc_id) == F.col(ids), "left_semi")
    one = one.withColumn(ids, F.row_number().over(order)).filter(F.col(ids) <= 1).drop(ids)
    return one.union(docs.filter(F.col(doc_id).isNull()))
