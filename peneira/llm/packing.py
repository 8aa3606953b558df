"""Packing documents into token windows by non-negative least squares."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peneira.llm.common import stored, texts_of
from peneira.llm.tokens import KNOWN_UNITS, encoder

WINDOW = 2048
SWEEPS = 12  # of the least-squares solver over all combinations
ENOUGH = 1e-3  # relative gain of a sweep below which it stops


def combinations(window: int, counts: np.ndarray) -> list[tuple[int, ...]]:
    """Two or three lengths that occur and add up to the window, two first, the most even last."""
    there = np.flatnonzero(counts).tolist()
    known = set(there)
    found: list[tuple[int, ...]] = [(a, window - a) for a in there if 2 * a <= window and window - a in known]
    for a in there:
        if 3 * a > window:
            break
        found += [(a, b, window - a - b) for b in there if a <= b <= window - a - b and window - a - b in known]
    return found


def solve_repeats(counts: np.ndarray, combos: list[tuple[int, ...]]) -> list[float]:
    """Non-negative repeats x that minimise the squared misfit of sum(x * lengths of each combination) to the histogram.

    Coordinate descent: each combination in turn gets the repeats that fit what the others leave
    over best, not below zero. The misfit never rises.
    """
    rest = counts.astype(float).tolist()
    repeats = [0.0] * len(combos)
    weights = [sum(c.count(x) ** 2 for x in set(c)) for c in combos]
    misfit = sum(r * r for r in rest)
    for _ in range(SWEEPS):
        for k, combo in enumerate(combos):
            step = max(sum(map(rest.__getitem__, combo)) / weights[k], -repeats[k])
            if step:
                repeats[k] += step
                for x in combo:
                    rest[x] -= step
        now = sum(r * r for r in rest)
        if misfit - now <= ENOUGH * misfit:
            break
        misfit = now
    return repeats


class Layout:
    """Where the pieces go: all from the histogram of the ends, a table of at most ``window`` numbers.

    Every document's whole windows are sequences of their own. Its end, shorter than a window, has a
    rank among the ends of the same length. Ranks below ``used`` of a length belong to
    combinations; the others form a row of tokens, longest first, that is cut at every window and,
    in its last window, at powers of two, so that no sequence needs padding.
    """

    def __init__(self, counts: list[int], windows: int, window: int = WINDOW):
        self.window = window
        self.first_combined = windows
        histogram = np.array(counts, np.int64)
        combos = combinations(window, histogram)
        repeats = solve_repeats(histogram, combos)
        left = histogram.copy()
        #: for each length: from which rank on, first sequence, offset there
        table: list[list[tuple[int, int, int]]] = [[] for _ in range(window)]
        used = [0] * window
        at = windows
        for k in sorted(range(len(combos)), key=lambda k: -repeats[k]):
            combo, times = combos[k], round(repeats[k])
            if not times:
                break
            times = min(times, *(int(left[x]) // combo.count(x) for x in combo))
            if times <= 0:
                continue
            offset = 0
            for x in combo:
                table[x].append((used[x], at, offset))
                used[x] += times
                left[x] -= times
                offset += x
            at += times
        self.table = [tuple(np.array(c, np.int64) for c in zip(*t, strict=True)) if t else None for t in table]
        self.used = used
        self.first_residual = at
        lengths = np.arange(window) * left
        self.row_start = (np.cumsum(lengths[::-1]) - lengths[::-1])[::-1]  # in the row of residual tokens
        total = int(lengths.sum())
        whole = total // window
        self.tail = whole * window
        cuts, place = [self.tail], self.tail
        for bit in reversed(range(window.bit_length())):
            if total - self.tail >> bit & 1:
                place += 1 << bit
                cuts.append(place)
        self.cuts = cuts

    def end_pieces(self, length: int, rank: int) -> list[tuple[int, int, int, int]]:
        """(start within the end, length, sequence, offset) of the end of this length and rank."""
        if rank < self.used[length]:
            ranks, sequences, offsets = self.table[length]
            k = int(np.searchsorted(ranks, rank, "right")) - 1
            return [(0, length, int(sequences[k]) + rank - int(ranks[k]), int(offsets[k]))]
        place = int(self.row_start[length]) + (rank - self.used[length]) * length
        pieces, start = [], 0
        while start < length:
            at = place + start
            if at < self.tail:
                sequence, begin, end = at // self.window, at // self.window * self.window, (at // self.window + 1) * self.window
            else:
                k = int(np.searchsorted(self.cuts, at, "right"))
                sequence, begin, end = self.tail // self.window + k - 1, self.cuts[k - 1], self.cuts[k]
            size = min(length - start, end - at)
            pieces.append((start, size, self.first_residual + sequence, at - begin))
            start += size
        return pieces


def tokenised(
    docs: DataFrame, tokenizer_file: str, end_id: int, window: int, doc_id: str, text: str, known_units: int
) -> DataFrame:
    """Every row's ids and length, with its place among what its task has read.

    ``end`` is the length beyond whole windows, ``rank`` counts the task's earlier rows with the same
    end, ``windows_before`` their whole windows. Written and read back, so that these places hold
    whatever is computed again later.
    """
    encode = encoder(docs.sparkSession, tokenizer_file, end_id, known_units)
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        ranks, windows = [0] * window, 0
        for batch in batches:
            sizes, ends, own, before, images = [], [], [], [], []
            for ids in encode(texts_of(batch.column(1))):
                n = len(ids)
                end = n % window
                sizes.append(n)
                ends.append(end)
                own.append(ranks[end])
                before.append(windows)
                ranks[end] += 1
                windows += n // window
                small = not (ids >> np.uint32(16)).any()
                images.append((b"\2" if small else b"\4") + ids.astype("<u2" if small else "<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([part] * len(sizes), pa.int32()),
                    pa.array(sizes, pa.int64()),
                    pa.array(ends, pa.int32()),
                    pa.array(own, pa.int64()),
                    pa.array(before, pa.int64()),
                    pa.array(images, pa.binary()),
                ],
                names=["doc_id", "part", "doc_tokens", "end", "rank", "windows_before", "image"],
            )

    schema = f"doc_id {kind}, part int, doc_tokens long, end int, rank long, windows_before long, image binary"
    return stored(rows.mapInArrow(work, schema), "tokens")


def pack(
    docs: DataFrame, tokenizer_file: str, end_id: int, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text",
    known_units: int = KNOWN_UNITS,
) -> DataFrame:
    """Every piece: ``doc_id``, ``start``, ``length``, ``doc_tokens``, ``sequence_id``, ``offset``, ``ids`` (little-endian 32 bits).

    A document's tokens are its ids and ``end_id``; null and empty texts have ``end_id`` alone.
    Whole windows are cut off first. Combinations of two or three ends that fill a window are
    repeated as non-negative least squares fits the histogram of end lengths, rounded and
    limited to what is left; the other ends are packed one after the other, cut where a window
    is full. Sequences are numbered from 0 without gaps; all hold ``window`` tokens, but for at most
    one of each smaller power of two. Which of two ends of equal length goes where follows the
    order of reading. Repeated rows are packed as often as they occur.
    """
    tokens = tokenised(docs, tokenizer_file, end_id, window, doc_id, text, known_units)
    spark = docs.sparkSession
    groups = stored(
        tokens.groupBy("part", "end").agg(
            F.count("*").alias("n"), F.sum(F.floor(F.col("doc_tokens") / window)).alias("windows")
        ),
        "ends",
    )
    counts = [0] * window
    for r in groups.groupBy("end").agg(F.sum("n").alias("n")).collect():  # a row for each length below the window
        if r.end:
            counts[r.end] = r.n
    firsts, total = [], 0
    for r in groups.groupBy("part").agg(F.sum("windows").alias("n")).orderBy("part").collect():  # a row for each task
        firsts.append((r.part, total))
        total += r.n
    layout = Layout(counts, total, window)
    order = Window.partitionBy("end").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = groups.select("part", "end", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("earlier"))
    first = F.broadcast(spark.createDataFrame(firsts, "part int, first long"))
    placed = tokens.join(earlier.join(first, "part"), ["part", "end"]).select(
        "doc_id",
        "doc_tokens",
        "end",
        (F.col("rank") + F.col("earlier")).alias("rank"),
        (F.col("windows_before") + F.col("first")).alias("sequence"),
        "image",
    )
    shared = spark.sparkContext.broadcast(vars(layout))
    kind = docs.schema[doc_id].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Layout.__new__(Layout)
        vars(own).update(shared.value)
        for batch in batches:
            pieces, images = [], []
            for k, (n, end, rank, sequence, image) in enumerate(
                zip(*(batch.column(i).to_pylist() for i in range(1, 6)), strict=True)
            ):
                ids = np.frombuffer(image, f"<u{image[0]}", offset=1).astype("<u4")
                whole = n // window
                found = [(w * window, window, sequence + w, 0) for w in range(whole)]
                if end:
                    found += [(whole * window + s, size, q, at) for s, size, q, at in own.end_pieces(end, rank)]
                for start, size, q, at in found:
                    pieces.append((k, start, size, n, q, at))
                    images.append(ids[start : start + size].tobytes())
                if len(images) >= 8192:
                    yield made(batch, pieces, images)
                    pieces, images = [], []
            if images:
                yield made(batch, pieces, images)

    def made(batch: pa.RecordBatch, pieces: list, images: list) -> pa.RecordBatch:
        columns = [pa.array(c, pa.int64()) for c in zip(*pieces, strict=True)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(columns[0]), *columns[1:], pa.array(images, pa.binary())],
            names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
        )

    return placed.mapInArrow(
        work,
        f"doc_id {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary",
    )
