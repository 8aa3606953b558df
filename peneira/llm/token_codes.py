"""Token ids in directly addressable codes: any token is read without decoding others."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peneira.llm.common import partitions, texts_of
from peneira.llm.tokens import KNOWN_UNITS, encoder
from peneira.workspace import new_folder

CHUNK_BITS = 8
RANK_BITS = 512  # bits of a bitmap that share an entry of the rank directory
SEGMENT_TOKENS = 1 << 20
MAGIC = b"DAC1"


def encode_codes(ids: np.ndarray) -> bytes:
    """The file image of a sequence of numbers below 2^64.

    Level 0 has the low 8 bits of every id, level 1 the next 8 bits of those ids that have more, and so
    on. Each level is an array of chunks and a bitmap that says which ids go on; the rank directory
    has the number of set bits before every block of 512. The i-th id goes on at level 1 at the
    position that is the rank of i in the bitmap.
    """
    levels, rest = [], ids.astype(np.uint64)
    while True:
        more = rest >> np.uint64(CHUNK_BITS) > 0
        blocks = -(-len(rest) // RANK_BITS)
        bitmap = np.zeros(blocks * RANK_BITS, bool)
        bitmap[: len(rest)] = more
        ranks = np.r_[0, np.cumsum(bitmap.reshape(blocks, RANK_BITS).sum(axis=1))].astype("<u4")
        levels.append(
            (rest & np.uint64(255)).astype(np.uint8).tobytes()
            + np.packbits(bitmap, bitorder="little").tobytes()
            + ranks.tobytes()
        )
        head = struct.pack("<Q", len(rest))
        levels[-1] = head + levels[-1]
        rest = rest[more] >> np.uint64(CHUNK_BITS)
        if not len(rest):
            return MAGIC + struct.pack("<I", len(levels)) + b"".join(levels)


class Codes:
    """Random access to a file image; the arrays are views of its bytes."""

    def __init__(self, image: bytes):
        if image[:4] != MAGIC:
            raise ValueError("not a file of directly addressable codes")
        self.chunks, self.bitmaps, self.ranks = [], [], []
        (levels,) = struct.unpack_from("<I", image, 4)
        at = 8
        for _ in range(levels):
            (n,) = struct.unpack_from("<Q", image, at)
            blocks = -(-n // RANK_BITS)
            self.chunks.append(np.frombuffer(image, np.uint8, n, at + 8))
            self.bitmaps.append(np.frombuffer(image, np.uint8, blocks * RANK_BITS // 8, at + 8 + n))
            self.ranks.append(np.frombuffer(image, "<u4", blocks + 1, at + 8 + n + blocks * RANK_BITS // 8))
            at += 8 + n + blocks * RANK_BITS // 8 + 4 * (blocks + 1)

    def __len__(self) -> int:
        return len(self.chunks[0])

    def rank(self, level: int, i: int) -> int:
        """Set bits of the level's bitmap before position i."""
        block = i // RANK_BITS
        whole = np.unpackbits(self.bitmaps[level][block * RANK_BITS // 8 : -(-i // 8)], bitorder="little")
        return int(self.ranks[level][block]) + int(whole[: i - block * RANK_BITS].sum())

    def __getitem__(self, i: int) -> int:
        """The i-th id: one chunk, one bit and one rank a level."""
        if not 0 <= i < len(self):
            raise IndexError(i)
        value = 0
        for level, chunks in enumerate(self.chunks):
            value |= int(chunks[i]) << (CHUNK_BITS * level)
            if not self.bitmaps[level][i >> 3] >> (i & 7) & 1:
                break
            i = self.rank(level, i)
        return value

    def read(self, start: int, stop: int, level: int = 0) -> np.ndarray:
        """The ids from start to stop: a slice of each level, found by rank."""
        wide = np.uint64 if len(self.chunks) > 4 else np.uint32
        values = self.chunks[level][start:stop].astype(wide)
        if stop > start:
            bits = np.unpackbits(self.bitmaps[level][start >> 3 : -(-stop // 8)], bitorder="little")
            more = bits[start & 7 :][: stop - start].astype(bool)
            if more.any():
                first = self.rank(level, start)
                values[more] |= self.read(first, first + int(more.sum()), level + 1) << wide(CHUNK_BITS)
        return values


SEGMENT = "part int, segment int, first long, n_tokens long, doc_ids array<bigint>, sizes array<bigint>, codes binary"


def write_codes(
    docs: DataFrame, path: str, tokenizer_file: str, end_id: int, doc_id: str = "doc_id", text: str = "text",
    segment_tokens: int = SEGMENT_TOKENS, known_units: int = KNOWN_UNITS,
) -> None:
    """Writes every text's ids, and ``end_id`` after each, in ascending id order.

    Rows are dealt out and sorted by id (nulls first, equal ids by a hash of the text, so that rows of one
    id are no hot key) before they are
    encoded, so text is shuffled once and ids never. Each task writes segments of about
    ``segment_tokens`` tokens, each a row of a Parquet file: a file image of codes, with the
    ids and sizes of its documents beside it. ``first`` counts the tokens of the task's earlier
    segments. Null and empty texts have the end id alone. A document is never split, so a
    larger one makes a larger segment.
    """
    encode = encoder(docs.sparkSession, tokenizer_file, end_id, known_units)
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    order = ("doc_id", F.xxhash64("text"))
    ordered = rows.repartitionByRange(partitions(docs.sparkSession), *order).sortWithinPartitions(*order, "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, first = TaskContext.get().partitionId(), 0, 0
        names: list = []
        held: list[np.ndarray] = []
        waiting = 0

        def segment() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([number], pa.int32()),
                    pa.array([first], pa.int64()),
                    pa.array([waiting], pa.int64()),
                    pa.array([names], pa.list_(pa.int64())),
                    pa.array([[len(x) for x in held]], pa.list_(pa.int64())),
                    pa.array([encode_codes(np.concatenate(held))], pa.binary()),
                ],
                names=["part", "segment", "first", "n_tokens", "doc_ids", "sizes", "codes"],
            )

        for batch in batches:
            for name, ids in zip(batch.column(0).to_pylist(), encode(texts_of(batch.column(1))), strict=True):
                names.append(name)
                held.append(ids)
                waiting += len(ids)
                if waiting >= segment_tokens:
                    yield segment()
                    names, held, number, first, waiting = [], [], number + 1, first + waiting, 0
        if held:
            yield segment()

    ordered.mapInArrow(work, SEGMENT).write.option("compression", "none").parquet(path)


def read_codes(spark: SparkSession, path: str, digest: Callable[[np.ndarray], int] | None = None) -> DataFrame:
    """A row for each document of the files: ``doc_id``, ``start``, ``n_tokens`` and ``ids``.

    ``start`` is the number of ids of all documents before it; each document is read
    through the rank directories of its segment. With ``digest``, the column ``digest`` has its
    value for the ids in place of the ids. An order of tasks is the order of ids,
    so the ids before a task's first are a running sum over tasks.
    """
    segments = spark.read.schema(SEGMENT).parquet(path)
    before, total = [], 0
    for r in segments.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect():
        before.append((r.part, total))
        total += r.n
    starts = F.broadcast(spark.createDataFrame(before, "part int, before long"))  # a row for each task that wrote

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, names, sizes, image in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                codes = Codes(image)
                ends = np.cumsum(np.array(sizes, np.int64))
                begins = ends - sizes
                each = (codes.read(int(a), int(b)) for a, b in zip(begins, ends, strict=True))
                last = (
                    pa.array([digest(ids) for ids in each], pa.int64())
                    if digest
                    else pa.array([ids for ids in each], pa.list_(pa.int64()))
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.int64()), pa.array(begins + start), pa.array(sizes, pa.int64()), last],
                    names=["doc_id", "start", "n_tokens", "digest" if digest else "ids"],
                )

    placed = segments.join(starts, "part").select(F.col("first") + F.col("before"), "doc_ids", "sizes", "codes")
    last = "digest bigint" if digest else "ids array<bigint>"
    return placed.mapInArrow(work, f"doc_id bigint, start bigint, n_tokens bigint, {last}")


def crc32_of(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def coded(docs: DataFrame, tokenizer_file: str, end_id: int, doc_id: str = "doc_id", text: str = "text", digest=None, **how) -> DataFrame:
    """``write_codes`` to a new shared folder, then ``read_codes`` from it."""
    path = new_folder(docs.sparkSession, "codes")
    write_codes(docs, path, tokenizer_file, end_id, doc_id, text, **how)
    return read_codes(docs.sparkSession, path, digest)
