"""Small helpers the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peneira.workspace import new_folder

CHUNK_CHARS = 1 << 20  # characters that are turned into arrays at a time


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to a new shared folder and read back.

    The plan that made them is cut off there: later steps read committed files,
    which every executor reaches and which outlive any of them.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def is_held_out(doc_id: str, parts: int, rest: int):
    """True where crc32 of the id as text leaves this remainder; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts == rest, F.lit(False))


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 of each text; null counts as empty."""
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def in_chunks(sizes: list[int], most: int = CHUNK_CHARS) -> Iterator[slice]:
    """Runs of neighbouring rows of about this total size; a larger row is a run of its own."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > most:
            yield slice(start, i)
            start, total = i, 0
        total += size
    if sizes:
        yield slice(start, len(sizes))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """64 well-mixed bits of each 64-bit key (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def per_batch(work: Callable[[pa.RecordBatch], dict], schema: pa.Schema) -> Callable:
    """A function for ``mapInArrow`` that turns each batch into columns of ``schema``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                columns = work(batch)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[f.name], f.type) if not isinstance(columns[f.name], pa.Array) else columns[f.name] for f in schema],
                    schema=schema,
                )

    return run


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each key as a table, from batches that are sorted by the keys.

    Holds one key's rows at a time; the caller sees to it that a key is of bounded size.
    """
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        changes = np.zeros(batch.num_rows, bool)
        for c in columns:
            changes[1:] |= c[1:] != c[:-1]
        starts = [0, *np.flatnonzero(changes).tolist(), batch.num_rows]
        if last is not None and tuple(c[0] for c in columns) != last:
            yield pa.Table.from_batches(held)
            held = []
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            if a:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
        last = tuple(c[-1] for c in columns)
    if held:
        yield pa.Table.from_batches(held)
