"""Secrets: fixed patterns, and formats learned as probabilistic automata."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peneira.llm.common import stored, texts_of

KINDS = ("assign", "access", "hex", "format")  # the first three by pattern, the last by automata
ORDINARY = "ordinary"

SAMPLE = 1500  # credentials of each kind, and ordinary runs, that automata are learned from
SAMPLE_CHARS = 200  # longest of them
CONFIDENCE = 0.05  # of the Hoeffding bound that two states differ
MARGIN = 1.0  # bits a character by which a format must explain a run better than ordinary text does
TYPICAL = 0.99  # share of a format's own credentials that need at most as many bits as a run may
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ASSIGN_HINTS = (b"passw", b"secret", b"token", b"api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
RUN = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{16,}")


def base_spans(text: str, lowered: bytes) -> tuple[list[tuple[int, int, int, str]], list[tuple[int, int]]]:
    """(start, end, kind, secret) of the pattern matches, and all long runs of credential characters.

    Access keys and hex strings lie inside such runs, so only runs are searched for them.
    ``lowered`` is the text in UTF-8 with A-Z lower-cased, to pass over texts without a key word.
    """
    spans = []
    if any(hint in lowered for hint in ASSIGN_HINTS):
        spans += [(m.start(), m.end(), 0, m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    runs = [m.span() for m in RUN.finditer(text)]
    for a, b in runs:
        spans += [(m.start(), m.end(), 1, m[0]) for m in ACCESS.finditer(text, a, b) if m.end() - m.start() >= 20]
        if b - a >= 24:
            spans += [(m.start(), m.end(), 2, m[0]) for m in HEX.finditer(text, a, b) if m.end() - m.start() >= 24]
    return sorted(spans), runs


def free_runs(spans: list, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The runs that no span overlaps; both are sorted by start."""
    if not spans:
        return runs
    free, k, reach = [], 0, 0
    for a, b in runs:
        while k < len(spans) and spans[k][0] < b:
            reach = max(reach, spans[k][1])
            k += 1
        if reach <= a:
            free.append((a, b))
    return free


def labelled_sample(docs: DataFrame, text: str, size: int = SAMPLE) -> dict[str, list[str]]:
    """For each pattern kind, and for ordinary runs, the ``size`` distinct strings of smallest hash.

    Every text is searched; each task keeps its ``size`` smallest of each kind, so the
    sample does not depend on how the texts are dealt out. Only strings of at most
    ``SAMPLE_CHARS`` characters are learned from.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, dict[str, int]] = {k: {} for k in (*KINDS[:3], ORDINARY)}
        limit = dict.fromkeys(held, 1 << 64)

        def add(kind: str, value: str) -> None:
            own = held[kind]
            if len(value) <= SAMPLE_CHARS and value not in own and (h := xxhash.xxh64_intdigest(value, 7)) < limit[kind]:
                own[value] = h
                if len(own) >= 2 * size:
                    best = sorted(own.items(), key=lambda x: (x[1], x[0]))[:size]
                    held[kind], limit[kind] = dict(best), best[-1][1]

        for batch in batches:
            for raw in texts_of(batch.column(0)):
                whole = raw.decode("utf-8", "replace")
                spans, runs = base_spans(whole, raw.lower())
                for _, _, kind, value in spans:
                    add(KINDS[kind], value)
                for a, b in free_runs(spans, runs):
                    add(ORDINARY, whole[a:b])
        rows = [(k, v, h >> 1) for k, own in held.items() for v, h in sorted(own.items(), key=lambda x: x[1])[:size]]
        yield pa.RecordBatch.from_pydict(
            {"kind": [r[0] for r in rows], "value": [r[1] for r in rows], "h": pa.array([r[2] for r in rows], pa.int64())}
        )

    found = docs.select(text).mapInArrow(work, "kind string, value string, h bigint")
    found = stored(found, "credentials").distinct()
    return {
        kind: [r.value for r in found.filter(F.col("kind") == kind).orderBy("h", "value").limit(size).collect()]
        for kind in (*KINDS[:3], ORDINARY)
    }


class _Tree:
    """Prefix tree with counts; its states are merged until none are compatible."""

    def __init__(self, words: list[str]):
        self.next: list[dict[str, int]] = [{}]
        self.uses: list[dict[str, int]] = [{}]
        self.ends, self.seen = [0], [0]
        for word in words:
            at = 0
            self.seen[0] += 1
            for c in word:
                if c not in self.next[at]:
                    self.next[at][c] = len(self.next)
                    self.next.append({})
                    self.uses.append({})
                    self.ends.append(0)
                    self.seen.append(0)
                self.uses[at][c] = self.uses[at].get(c, 0) + 1
                at = self.next[at][c]
                self.seen[at] += 1
            self.ends[at] += 1

    def _differ(self, a: int, b: int) -> float:
        """How far the choices after two states are apart; infinite if beyond chance here or further on."""
        stack, first = [(a, b)], None
        while stack:
            a, b = stack.pop()
            n, m = self.seen[a], self.seen[b]
            if not n or not m:
                continue
            bound = math.sqrt(0.5 * math.log(2 / CONFIDENCE)) * (n**-0.5 + m**-0.5)
            gaps = [abs(self.ends[a] / n - self.ends[b] / m)]
            for c in self.uses[a].keys() | self.uses[b].keys():
                gaps.append(abs(self.uses[a].get(c, 0) / n - self.uses[b].get(c, 0) / m))
                if c in self.next[a] and c in self.next[b]:
                    stack.append((self.next[a][c], self.next[b][c]))
            if max(gaps) > bound:
                return math.inf
            first = sum(gaps) if first is None else first
        return first or 0.0

    def _fold(self, into: int, other: int) -> None:
        stack = [(into, other)]
        while stack:
            a, b = stack.pop()
            self.seen[a] += self.seen[b]
            self.ends[a] += self.ends[b]
            for c, n in self.uses[b].items():
                self.uses[a][c] = self.uses[a].get(c, 0) + n
                if c in self.next[a]:
                    stack.append((self.next[a][c], self.next[b][c]))
                else:
                    self.next[a][c] = self.next[b][c]

    def merged(self) -> list[int]:
        """Merges each state next to a settled one into the settled state it fits best; settles it if none fits."""
        settled, known = [0], {0}
        while True:
            edges = [(self.uses[s][c], -s, c) for s in settled for c, t in self.next[s].items() if t not in known]
            if not edges:
                return settled
            _, s, c = max(edges)
            state = self.next[-s][c]
            gap, best = min((self._differ(r, state), r) for r in settled)
            if gap == math.inf:
                settled.append(state)
                known.add(state)
            else:
                self.next[-s][c] = best
                self._fold(best, state)


def learn_automaton(words: list[str]) -> list[dict[str, tuple[float, int]]] | None:
    """For each state, the cost in bits and the next state of each character; '' is the end.

    States of the prefix tree whose choices do not differ beyond the Hoeffding bound,
    nor those of their descendants, are merged. A character that a state has not
    seen costs its smoothed share and leaves the state as it is.
    """
    if not words:
        return None
    tree = _Tree(words)
    settled = tree.merged()
    number = {s: k for k, s in enumerate(settled)}
    states = []
    for s in settled:
        total = tree.seen[s] + 1.0
        share = 1.0 / (len(ALPHABET) + 1)
        moves = {c: (-math.log2(share / total), number[s]) for c in ALPHABET}
        for c, n in tree.uses[s].items():
            moves[c] = (-math.log2((n + share) / total), number[tree.next[s][c]])
        moves[""] = (-math.log2((tree.ends[s] + share) / total), number[s])
        states.append(moves)
    return states


def cost(states: list[dict[str, tuple[float, int]]], word: str) -> float:
    """Bits that the automaton needs for the word and its end."""
    at, bits = 0, 0.0
    for c in word:
        own, at = states[at][c]
        bits += own
    return bits + states[at][""][0]


def learn_formats(docs: DataFrame, text: str = "text", size: int = SAMPLE) -> dict[str, tuple[list, float]]:
    """For each kind that occurs, and for ordinary runs, an automaton and the bits a character that are typical of it."""
    formats = {}
    for kind, words in labelled_sample(docs, text, size).items():
        if (states := learn_automaton(words)) is not None:
            own = sorted(cost(states, w) / len(w) for w in words if set(w) <= set(ALPHABET))
            formats[kind] = (states, own[int(TYPICAL * (len(own) - 1))] if own else 0.0)
    return formats


def fits_a_format(formats: dict[str, tuple[list, float]], word: str) -> bool:
    """Whether a format explains the word as well as its own credentials, and by ``MARGIN`` better than ordinary text.

    Where there is no ordinary text to compare with, evenly drawn characters take its place.
    """
    plain = cost(formats[ORDINARY][0], word) if ORDINARY in formats else (len(word) + 1) * math.log2(len(ALPHABET) + 1)
    for kind, (states, typical) in formats.items():
        bits = cost(states, word)
        if kind != ORDINARY and bits <= typical * len(word) and plain - bits >= MARGIN * len(word):
            return True
    return False


def likeliest(formats: dict[str, tuple[list, float]], word: str) -> tuple[str | None, float | None]:
    """The kind whose automaton needs the fewest bits for the word, and these bits a character; ties go by name."""
    found = [(cost(states, word) / len(word), kind) for kind, (states, _) in formats.items() if kind != ORDINARY]
    bits, kind = min(found, default=(None, None))
    return kind, bits


def _finder(spark, formats: dict[str, tuple[list, float]]):
    shared = spark.sparkContext.broadcast(formats)
    known: dict[str, bool] = {}

    def spans_of(raw: bytes) -> tuple[str, list[tuple[int, int, int, str]]]:
        text = raw.decode("utf-8", "replace")
        base, runs = base_spans(text, raw.lower())
        found = list(base)
        for a, b in free_runs(base, runs):
            word = text[a:b]
            if word not in known:
                if len(known) > 200_000:
                    known.clear()
                known[word] = fits_a_format(shared.value, word)
            if known[word]:
                found.append((a, b, 3, word))
        return text, sorted(found, key=lambda s: (s[0], s[2]))

    return spans_of


def scan(docs: DataFrame, formats: dict[str, tuple[list, float]], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's ``doc_id``, ``spans``: an array of (kind, start, end), by start, then kind; and their ``scores``.

    Offsets count code points, ends are exclusive. ``assign``, ``access`` and ``hex`` are the
    pattern matches, leftmost and not overlapping within a kind. ``format`` is a run of 16 or
    more credential characters that overlaps no pattern match and whose likelihood under a learned
    automaton is that of credentials, see ``fits_a_format``. ``scores`` has, for each span, the
    kind ``likely`` whose automaton explains its secret best, and its ``bits`` a character; null where nothing was learned.
    Null and empty texts have no spans. Texts are searched whole, whatever their length; repeated rows
    and null ids are rows like others, and other columns are left out.
    """
    spans_of = _finder(docs.sparkSession, formats)
    automata = docs.sparkSession.sparkContext.broadcast(formats)
    kind = docs.schema[doc_id].dataType.simpleString()
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    score = pa.list_(pa.struct([("likely", pa.string()), ("bits", pa.float64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, dict] = {}

        def scored(secret: str) -> dict:
            if secret not in known:
                if len(known) > 200_000:
                    known.clear()
                known[secret] = dict(zip(("likely", "bits"), likeliest(automata.value, secret), strict=True))
            return known[secret]

        for batch in batches:
            found = [spans_of(raw)[1] for raw in texts_of(batch.column(1))]
            spans = [[{"kind": KINDS[k], "start": a, "end": b} for a, b, k, _ in own] for own in found]
            scores = [[scored(secret) for *_, secret in own] for own in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(spans, span), pa.array(scores, score)], names=["doc_id", "spans", "scores"]
            )

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    spans = "spans array<struct<kind: string, start: bigint, end: bigint>>"
    return rows.mapInArrow(work, f"doc_id {kind}, {spans}, scores array<struct<likely: string, bits: double>>")


def redact(docs: DataFrame, formats: dict[str, tuple[list, float]], text: str = "text", mark: str = "[secret]") -> DataFrame:
    """All rows and columns, with ``mark`` in place of every span; overlapping spans get one mark.

    Null texts stay null, empty ones empty; columns of any other name are kept as they are.
    """
    spans_of = _finder(docs.sparkSession, formats)
    place = docs.columns.index(text)

    def clean(raw: bytes | None) -> str | None:
        if raw is None:
            return None
        whole, spans = spans_of(raw)
        parts, at = [], 0
        for a, b, *_ in spans:
            if a >= at:
                parts += [whole[at:a], mark]
            at = max(at, b)
        return "".join([*parts, whole[at:]])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [clean(raw) for raw in batch.column(place).cast(pa.binary()).to_pylist()]
            yield batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type))

    return docs.mapInArrow(work, docs.schema)
