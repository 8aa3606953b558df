"""Benchmark passages in documents: q-gram lemma filter, then banded alignment."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peneira.llm.common import code_points, in_chunks, mixed, texts_of

Q = 8  # characters of a q-gram, fewer for passages that would not share one within their edits
EDITS = 0.1  # edits allowed, as a share of the passage's characters
BLOCK_CHARS = 8 << 20  # benchmark text that is searched for in one pass over the documents
BITS = 22  # of the table that most positions are passed over with, at most


def folding() -> np.ndarray:
    """For each code point, the one it is compared as: lower case, and one blank for all white space."""
    table = np.arange(0x110000, dtype=np.uint32)
    for c in range(0x20000):
        low = chr(c).lower()
        table[c] = 32 if chr(c).isspace() else ord(low) if len(low) == 1 else c
    return table


def gram_keys(points: np.ndarray, q: int = Q) -> np.ndarray:
    """A 64-bit key for each position's q-gram."""
    if len(points) < q:
        return np.zeros(0, np.uint64)
    wide, n = points.astype(np.uint64), len(points) - q + 1
    key = wide[:n].copy()
    with np.errstate(over="ignore"):
        for k in range(1, q):
            key *= np.uint64(0x9E3779B97F4A7C15)
            key += wide[k : k + n]
    return mixed(key, 0)


def budget(size: int, edits: float = EDITS) -> int:
    """Edits allowed for a passage: the given share of its characters, rounded down."""
    return int(size * edits)


def gram_chars(size: int, edits: float = EDITS) -> int:
    """Characters of a passage's q-grams: ``Q``, or so many that a match must share one, m - q + 1 - k q >= 1."""
    return min(Q, size // (budget(size, edits) + 1))


def make_index(items: list[tuple[int, str]], edits: float = EDITS) -> dict[str, object]:
    """``parts``, one index for each size of q-gram that the passages need, and the ``folding`` of characters.

    Passages that are empty or nothing but white space are in none.
    """
    table = folding()
    by_size: dict[int, list[tuple[int, np.ndarray]]] = {}
    for i, text in items:
        points = table[code_points(text)]
        if (points != 32).any():
            by_size.setdefault(gram_chars(len(points), edits), []).append((i, points))
    return {"folding": table, "parts": [_part(folds, q, edits) for q, folds in sorted(by_size.items())]}


def _part(folds: list[tuple[int, np.ndarray]], q: int, edits: float) -> dict[str, np.ndarray]:
    """The passages' q-grams, sorted by key, and each passage's budget, need and characters.

    A text within k edits of a passage of m characters shares at least m - q + 1 - k q of
    its q-grams. Leaving out d positions lowers that bound by d, so up to half of it are left
    out, those whose q-gram is most frequent among the passages: fewer chance hits, no match lost.
    """
    grams = [gram_keys(p, q) for _, p in folds]
    _, which, often = np.unique(np.concatenate(grams), return_inverse=True, return_counts=True)
    often, at = often[which], 0
    keys, owner, position, need = [], [], [], []
    for k, ((_, points), own) in enumerate(zip(folds, grams, strict=True)):
        bound = len(own) - budget(len(points), edits) * q
        drop = bound // 2
        order = np.argsort(often[at : at + len(own)], kind="stable")
        kept = np.sort(order[: len(own) - drop])
        at += len(own)
        keys.append(own[kept])
        owner.append(np.full(len(kept), k))
        position.append(kept)
        need.append(bound - drop)
    keys, owner, position = map(np.concatenate, (keys, owner, position))
    order = np.argsort(keys, kind="stable")
    bits = min(BITS, (64 * len(keys)).bit_length())
    seen = np.zeros(1 << bits, bool)
    seen[(keys >> np.uint64(64 - bits)).astype(np.int64)] = True
    sizes = np.array([len(p) for _, p in folds])
    return {
        "q": q,
        "bits": bits,
        "keys": keys[order],
        "owner": owner[order],
        "position": position[order],
        "seen": seen,
        "need": np.array(need),
        "edits": np.array([budget(n, edits) for n in sizes]),
        "sizes": sizes,
        "starts": np.cumsum(sizes) - sizes,
        "points": np.concatenate([p for _, p in folds]),
        "ids": np.array([i for i, _ in folds], np.int64),
    }


def candidate_bands(keys: np.ndarray, index: dict[str, np.ndarray]) -> list[tuple[int, int]]:
    """(passage, lowest diagonal) of the bands of a text that share enough q-grams.

    A match's q-grams lie on diagonals no further apart than its edits k. Bands of
    2 (k + 1) diagonals start at every multiple of k + 1, so each match is within one.
    """
    at = np.flatnonzero(index["seen"][(keys >> np.uint64(64 - index["bits"])).astype(np.int64)])
    own = keys[at]
    low = np.searchsorted(index["keys"], own, "left")
    counts = np.searchsorted(index["keys"], own, "right") - low
    hit = counts > 0
    at, low, counts = at[hit], low[hit], counts[hit]
    if not len(at):
        return []
    entry = np.repeat(low - np.r_[0, np.cumsum(counts)[:-1]], counts) + np.arange(counts.sum())
    passage = index["owner"][entry]
    width = index["edits"][passage] + 1
    diagonal = np.repeat(at, counts) - index["position"][entry]
    band = np.floor_divide(diagonal, width)
    span = 1 << 40  # bands of a passage, all above -span / 2
    both = np.concatenate([passage * span + band + span // 2, passage * span + band - 1 + span // 2])
    found, shared = np.unique(both, return_counts=True)
    passage = found // span
    good = shared >= index["need"][passage]
    passage, band = passage[good], (found % span - span // 2)[good]
    return list(zip(passage.tolist(), (band * (index["edits"][passage] + 1)).tolist(), strict=True))


def _band_edits(passage: np.ndarray, text: np.ndarray, low: int, width: int, most: int) -> np.ndarray | None:
    """Edits of the best alignment of the whole passage that ends on each diagonal low .. low + width - 1.

    It may start on any of them. None as soon as every diagonal needs more than ``most`` edits.
    """
    far, steps = most + 1, np.arange(width)
    padded = np.full(len(passage) + width, -1, np.int64)  # the text's characters that the band covers
    a, b = max(low, 0), min(low + len(padded), len(text))
    if b > a:
        padded[a - low : b - low] = text[a:b]
    row = np.where(steps + low < 0, far, 0)
    for i, c in enumerate(passage):
        there = padded[i : i + width]
        here = np.where(there == -1, far, row + (there != c))
        here[:-1] = np.minimum(here[:-1], row[1:] + 1)  # a character of the passage is left out
        row = np.minimum(np.minimum.accumulate(here - steps) + steps, far)  # characters of the text are left out
        if row.min() > most:
            return None
    row[steps + low + len(passage) > len(text)] = far
    return row


def _prefix_edits(passage: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Edits between the passage and every prefix of the text, the empty one first."""
    steps = np.arange(len(text) + 1)
    row = steps.copy()
    for c in passage:
        here = np.r_[row[0] + 1, np.minimum(row[:-1] + (text != c), row[1:] + 1)]
        row = np.minimum.accumulate(here - steps) + steps
    return row


def verify(text: np.ndarray, passage: np.ndarray, low: int, most: int) -> tuple[int, int, int] | None:
    """(start, end, edits) of the best match near a band of 2 (``most`` + 1) diagonals, if within the edits.

    The alignment's band is wider by ``most`` on either side, so that a path may leave the
    diagonals of its q-grams. Of equally good matches, the first end and then the longest.
    """
    size = len(passage)
    for d in range(max(low, 0), min(low + 2 * (most + 1), len(text) - size + 1)):
        if text[d] == passage[0] and np.array_equal(text[d : d + size], passage):
            return d, d + size, 0
    row = _band_edits(passage, text, low - most, 4 * most + 2, most)
    if row is None or (edits := int(row.min())) > most:
        return None
    end = int(np.argmin(row)) + low - most + size
    back = _prefix_edits(passage[::-1], text[max(end - size - edits, 0) : end][::-1])
    return end - int(np.flatnonzero(back == edits)[-1]), end, edits


def search(texts: list[str], index: dict[str, object]) -> list[list[tuple[int, int, int, int]]]:
    """(item id, start, end, edits) of the passages in each text, by item and start.

    The texts are looked through as one; a candidate is verified in each text that it touches.
    """
    found: list[set] = [set() for _ in texts]
    joined = index["folding"][code_points("".join(texts))]
    ends = np.cumsum([len(t) for t in texts])
    for part in index["parts"]:
        for k, low in candidate_bands(gram_keys(joined, part["q"]), part):
            at, size, most = int(part["starts"][k]), int(part["sizes"][k]), int(part["edits"][k])
            first = int(np.searchsorted(ends, max(low, 0), "right"))
            last = int(np.searchsorted(ends, low + 2 * (most + 1) + size, "left"))
            for n in range(first, min(last, len(texts) - 1) + 1):
                start = int(ends[n]) - len(texts[n])
                hit = verify(joined[start : int(ends[n])], part["points"][at : at + size], low - start, most)
                if hit is not None:
                    found[n].add((int(part["ids"][k]), *hit))
    return [sorted(f) for f in found]


def _blocks(benchmark: DataFrame, item_id: str, text: str, block_chars: int) -> Iterator[dict[str, object]]:
    """Indexes of at most about ``block_chars`` characters each; most benchmarks are one."""
    rows = benchmark.select(F.col(item_id).alias("i"), F.col(text).alias("t")).filter("i is not null and t is not null")
    total = rows.agg(F.sum(F.char_length("t"))).first()[0] or 0
    parts = -(-total // block_chars)
    for part in range(parts):
        own = rows.filter(F.pmod(F.xxhash64("i", "t"), F.lit(parts)) == part).collect()
        index = make_index(sorted((r.i, r.t) for r in own))
        if index["parts"]:
            yield index


def _search(index: dict[str, object], column: pa.Array) -> Iterator[list[tuple[int, int, int, int]]]:
    texts = [t.decode("utf-8", "replace") for t in texts_of(column)]
    for run in in_chunks([len(t) for t in texts]):
        yield from search(texts[run], index)


def passages_in(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """A row for every benchmark passage that a document holds within the edit budget.

    Columns ``doc_id``, ``item_id``, ``start_char``, ``end_char`` (exclusive, in code points) and ``edits``.
    Case and kind of white space are ignored. Whole passages of any length are looked for, with up to
    ``EDITS`` of their characters, rounded down, in edits: those of fewer than 10 characters as they are,
    wherever they stand. Null passages, those of white space alone and those without an id match nothing, as do null
    and empty texts. Texts are looked through whole, however long. A repeated document gives its own rows; a repeated
    passage of one id gives none twice. Other columns are not read, whatever their names. The index is
    broadcast in blocks of bounded size, each with a pass of its own over the documents; there is no shuffle.
    """
    spark = docs.sparkSession
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {kind}, item_id bigint, start_char bigint, end_char bigint, edits int"
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    result = spark.createDataFrame([], schema)
    for index in _blocks(benchmark, item_id, item_text, block_chars):
        shared = spark.sparkContext.broadcast(index)

        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [(k, *hit) for k, hits in enumerate(_search(shared.value, batch.column(1))) for hit in hits]
                columns = list(zip(*found, strict=True)) or [[], [], [], [], []]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(columns[0], pa.int64())),
                        *(pa.array(c, pa.int64()) for c in columns[1:4]),
                        pa.array(columns[4], pa.int32()),
                    ],
                    names=["doc_id", "item_id", "start_char", "end_char", "edits"],
                )

        result = result.union(rows.mapInArrow(work, schema))
    return result


def without_passages(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """The rows that hold no benchmark passage, as ``passages_in`` finds them; columns unchanged, whatever their names.

    Null and empty texts hold none. Repeated rows stay or go together.
    """
    place = docs.columns.index(text)
    for index in _blocks(benchmark, item_id, item_text, BLOCK_CHARS):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array([not hits for hits in _search(shared.value, batch.column(place))], pa.bool_()))

        docs = docs.mapInArrow(work, docs.schema)
    return docs
