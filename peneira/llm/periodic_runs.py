"""Runs of words that repeat with a period, found by minimizers of several scales."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, StructType

from peneira.llm.common import in_chunks, mixed, texts_of

LEAST_LENGTH = 6  # words of a run
LEAST_TURNS = 4  # periods of a run; the minimizers need four at least
SCAN = 8  # periods below this are scanned for directly; a power of two

Run = tuple[int, int, int]  # start, end, period


def _least_length(period: int) -> int:
    return max(LEAST_LENGTH, LEAST_TURNS * period)


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], same.view(np.int8), [0]])))
    return edges[::2], edges[1::2]


def _scanned(words: np.ndarray, period: int) -> list[Run]:
    """All stretches of at least the length of a run whose words equal those one period on."""
    if len(words) <= period:
        return []
    starts, ends = _stretches(words[:-period] == words[period:])
    long = ends - starts >= _least_length(period) - period
    return [(s, e + period, period) for s, e in zip(starts[long].tolist(), ends[long].tolist(), strict=True)]


def _doubled(names: np.ndarray, at: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of the grams twice as long, and their places; a gram that does not repeat is left out.

    ``names`` are those of the grams of length ``step`` at the places ``at`` (ascending). Equal names
    mean equal grams: they are numbered by sorting, so that no two different ones are taken for one.
    """
    other = np.searchsorted(at, at + step)
    other[other == len(at)] = 0
    whole = np.flatnonzero(at[other] == at + step)  # both halves repeat
    first, second, at = names[whole], names[other[whole]], at[whole]
    order = np.lexsort((second, first))
    new = np.ones(len(order), bool)
    new[1:] = (first[order][1:] != first[order][:-1]) | (second[order][1:] != second[order][:-1])
    number = np.cumsum(new) - 1
    repeats = np.bincount(number, minlength=1)[number] > 1
    result = np.full(len(order), -1)
    result[order[repeats]] = number[repeats]
    kept = result >= 0
    return result[kept], at[kept]


def _window_minima(names: np.ndarray, at: np.ndarray, size: int, width: int) -> np.ndarray:
    """Indices into ``at`` of the least gram of every window of ``width`` places, by a hash of the
    name, the first of equal ones. Grams that were left out are in no window's minimum."""
    top = np.uint64(2**64 - 1)
    value = np.full(size + width, top)
    value[at] = mixed(names, 1) >> np.uint64(1)
    # The least value from each place to its block's end, and from its block's start to each place.
    blocks = -(-len(value) // width)
    padded = np.full(blocks * width, top)
    padded[: len(value)] = value
    square = padded.reshape(blocks, width)
    forward = np.minimum.accumulate(square, axis=1).ravel()
    backward = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(backward[:size], forward[width - 1 : width - 1 + size])
    # The first place of that value in the window is the next one at or after its start.
    kinds, rank = np.unique(value[at], return_inverse=True)
    order = np.lexsort((at, rank))
    wanted = np.flatnonzero(least < top)
    joint = rank[order] * (size + 1) + at[order]
    chosen = np.zeros(len(at), bool)
    chosen[order[np.searchsorted(joint, np.searchsorted(kinds, least[wanted]) * (size + 1) + wanted)]] = True
    return np.flatnonzero(chosen)


def _common(words: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """The stretch around ``at`` whose words equal those one period on, as (start, end) with the last period."""
    end, step = at, 64
    while end < len(words) - period:
        to = min(end + step, len(words) - period)
        differ = np.flatnonzero(words[end:to] != words[end + period : to + period])
        if len(differ):
            end += int(differ[0])
            break
        end, step = to, step * 2
    start, step = at, 64
    while start > 0:
        low = max(start - step, 0)
        differ = np.flatnonzero(words[low:start] != words[low + period : start + period])
        if len(differ):
            start = low + int(differ[-1]) + 1
            break
        start, step = low, step * 2
    return start, end + period


def _smallest(words: np.ndarray, run: Run) -> bool:
    """Whether no smaller period fits. A run holds two periods and more, so that such a one would divide it."""
    start, end, period = run
    rest, prime = period, 2
    while rest > 1:
        if rest % prime:
            prime = prime + 1 if prime * prime <= rest else rest
            continue
        while rest % prime == 0:
            rest //= prime
        shorter = period // prime
        if np.array_equal(words[start : end - shorter], words[start + shorter : end]):
            return False
    return True


def runs_of(words: np.ndarray, owner: np.ndarray) -> list[Run]:
    """All runs, by start and then period, of texts one after the other: a number for each word, and its text's.

    A run is a stretch of words of one text with smallest period q, ``max(6, 4 q)`` words at least, that
    no neighbouring word extends. Periods below ``SCAN`` are found by comparing all words with those
    one period on. Periods from P to 2 P - 1, for P = 8, 16, ..: of the grams of 2 P words, the least
    in each window of P places is a minimizer. A run of four periods holds whole a window and the same
    one a period later, so their minimizers are equal grams one period apart; as a gram is at least
    a period long, it stands nowhere between. So each minimizer with the next one equal to it
    gives one pair to be extended word by word, and no run is missed. Grams that a text holds once are
    left out of the minima, as none of a run's is.
    """
    if not len(words):
        return []
    last = int(owner.max()) + 1
    parted = words.astype(np.int64) * last + owner  # words of different texts differ
    found = {run for period in range(1, SCAN) for run in _scanned(parted, period)}
    at = np.flatnonzero(np.bincount(owner)[owner] >= LEAST_TURNS * SCAN)
    names = parted[at]
    step = 1
    while step < 2 * SCAN and len(at):
        names, at = _doubled(names, at, step)
        step *= 2
    scale = SCAN
    while len(at):  # grams of 2 * scale words
        picked = _window_minima(names, at, len(parted), scale)
        places, kinds = at[picked], names[picked]
        order = np.lexsort((places, kinds))
        places, kinds = places[order], kinds[order]
        apart = np.diff(places)
        pairs = np.flatnonzero((np.diff(kinds) == 0) & (apart >= scale) & (apart < 2 * scale))
        ends: dict[int, int] = {}  # of the last stretch of each period
        for place, period in sorted(zip(places[pairs].tolist(), apart[pairs].tolist(), strict=True)):
            if place + period < ends.get(period, 0):
                continue
            start, end = _common(parted, place, period)
            ends[period] = end
            if end - start >= _least_length(period):
                found.add((start, end, period))
        names, at = _doubled(names, at, step)
        step, scale = step * 2, scale * 2
    return sorted((s, e, q) for s, e, q in found if _smallest(parted, (s, e, q)))


def _of_batch(texts: list[bytes]) -> Iterator[tuple[list[Run], bytes]]:
    """The runs of each text, in its own word numbers, and the text without its repeats."""
    split = [t.split() for t in texts]  # at the blanks \x20 and \x09 to \x0D
    known: dict[bytes, int] = {}
    numbers = np.array([known.setdefault(w, len(known)) for own in split for w in own], np.int64)
    sizes = np.array([len(own) for own in split])
    first = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(split)), sizes)
    own_runs: dict[int, list[Run]] = {}
    for s, e, q in runs_of(numbers, owner):
        k = int(owner[s])
        own_runs.setdefault(k, []).append((s - int(first[k]), e - int(first[k]), q))
    for k, words in enumerate(split):
        runs = own_runs.get(k, [])
        if runs:
            gone = np.zeros(len(words), bool)
            for s, e, q in runs:
                gone[s + q : e] = True
            words = [words[i] for i in np.flatnonzero(~gone).tolist()]
        yield runs, b" ".join(words)


def find_runs(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns in ``keep`` of every row, with the runs of its text and the text without their repeats.

    ``runs`` is an array of structs ``start``, ``length``, ``period`` in words, by start and then period;
    ``collapsed`` the words that no run holds after its first period, joined by one blank. Words are what
    stands between blanks (space, tab, line ends); see ``runs_of`` for what a run is.

    Null and empty texts, and texts of blanks, have no runs and an empty ``collapsed``. A text is taken
    whole, however long; about a million characters at a time are worked on together. Repeated rows are
    treated alike, no rows give no rows. Columns outside ``keep`` are not read, so their names do not
    matter; none in ``keep`` may be called ``runs`` or ``collapsed``. No shuffle.
    """
    keep = ["doc_id"] if keep is None else keep
    rows = docs.select(*keep, text).toDF(*keep, f"{text} of a document")
    span = ArrayType(StructType.fromDDL("start long, length long, period long"))
    kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(len(keep)))
            for some in in_chunks([len(t) for t in texts]):
                counts, spans, collapsed = [0], [], []
                for runs, rest in _of_batch(texts[some]):
                    spans += runs
                    counts.append(len(spans))
                    collapsed.append(rest)
                s, e, q = (np.array([r[i] for r in spans], np.int64) for i in range(3))
                structs = pa.StructArray.from_arrays([pa.array(s), pa.array(e - s), pa.array(q)], fields=list(kind))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(c.slice(some.start, some.stop - some.start) for c in batch.columns[: len(keep)]),
                        pa.ListArray.from_arrays(pa.array(counts, pa.int32()), structs),
                        pa.array(collapsed, pa.binary()).cast(pa.string()),
                    ],
                    names=[*keep, "runs", "collapsed"],
                )

    schema = rows.drop(rows.columns[-1]).schema.add("runs", span).add("collapsed", "string")
    return rows.mapInArrow(work, schema)
