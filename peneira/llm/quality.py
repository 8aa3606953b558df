"""Quality scores: weak labels by expectation-maximisation, then a hashed linear scorer."""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peneira.llm.common import code_points, stored, texts_of

SAMPLE = 12_000  # documents that the scorers are fitted on, by hash of the id
LABELLED = 20_000  # labelled documents that unwanted terms are learned from, by hash of the id
STEM = 6  # letters of a word that count as a term of their own
LONG = 200  # words from which on a word's weight no longer falls with the text's length
SLOTS = 1 << 22  # weights of a scorer
SEEN = 5  # sample documents that a slot must occur in to get a weight
ROUNDS = 60  # of expectation-maximisation
PASSES = 60  # of the scorer's fit over its sample
RIDGE = 1e-6  # weight of the squared weights in its loss
BREAKS = r"[\x20\x09-\x0D]+"

# Frequent short words of the languages in the tables; fixed values, in no order of importance.
FUNCTION_WORDS = """a an and are as at be by for from in is it of on or that the this to was with
der die das den dem und ist im in zu von mit auf für ein eine nicht sich
de la le les des et en du un une que qui pour dans sur par au
el los las y del por con para una se es""".split()
FUNCTION_WORDS = list(dict.fromkeys(FUNCTION_WORDS))


@dataclass(frozen=True)
class Labeller:
    """A heuristic: which rows it calls good and which bad; it says nothing of the others."""

    name: str
    good: Column
    bad: Column

    @property
    def vote(self) -> Column:
        return F.when(self.bad, -1).when(self.good, 1).otherwise(0).cast("tinyint").alias(self.name)


def with_stems(words: Column) -> Column:
    """The distinct words and their first letters."""
    return F.array_union(words, F.transform(words, lambda w: F.substring(w, 1, STEM)))


_CACHE: dict[str, np.ndarray] = {}
MEASURES = ("letters", "odd", "capitals", "distinct", "again", "common", "stops", "word_chars")


def _kinds() -> np.ndarray:
    """For each code point: 1 a letter, 2 a capital, 3 neither letter, digit, white space nor common punctuation, else 0."""
    if "kinds" not in _CACHE:
        kinds = np.zeros(0x110000, np.uint8)
        for c in map(chr, range(0x110000)):
            if c.isalpha():
                kinds[ord(c)] = 2 if c.isupper() else 1
            elif not (c.isnumeric() or c.isspace() or c in ".,;:!?'\"()-"):
                kinds[ord(c)] = 3
        _CACHE["kinds"] = kinds
    return _CACHE["kinds"]


def measures(text: str, terms: dict[str, int]) -> tuple[int, dict[str, float], set[int]]:
    """Number of words, shares of the text's characters and words, and the lists of ``terms`` that it has a word of."""
    words = text.lower().split()
    counts = Counter(words)
    _, small, capital, odd = np.bincount(_kinds()[code_points(text)], minlength=4).tolist()
    n, spoken = max(len(words), 1), small + capital
    lists = set()
    for word in counts if terms else ():
        plain = word if word.isalpha() else "".join(filter(str.isalpha, word))
        lists |= {terms[t] for t in (plain, plain[:STEM]) if t in terms}
    values = (
        spoken / max(len(text), 1),
        odd / max(len(text), 1),
        capital / max(spoken, 1),
        len(counts) / n,
        sum(map(operator.eq, words, words[1:])) / n,
        sum(counts[w] for w in FUNCTION_WORDS if w in counts) / n,
        sum(k for w, k in counts.items() if w[-1] in ".!?") / n,
        spoken / n,
    )
    return len(words), dict(zip(MEASURES, values, strict=True)), lists


def measured(rows: DataFrame, terms: list[str], share: float = 0.0) -> DataFrame:
    """The measures of all rows (``doc_id``, ``text``) that the labellers look at; null counts as empty.

    For about this share of the different rows, by ``hash`` of id and text, also their ``slots`` and ``values``.
    Of rows that repeat in full, each task takes at most one.
    """
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast({t: k % 3 for k, t in enumerate(terms)})
    below = int((1 << 62) * min(share, 1.0))
    hashed = F.shiftrightunsigned(F.xxhash64("doc_id", "text", F.lit(3)), 2)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes: dict[str, str] = {}
        taken: set[int] = set()  # at most the sample
        for batch in batches:
            found, slots, values = [], [], []
            for h, raw in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                whole = raw.decode("utf-8", "replace")
                found.append(measures(whole, shared.value))
                if h < below and h not in taken:
                    taken.add(h)
                    s, v = features(whole, shapes)
                    slots.append(s.astype(np.int32).tobytes())
                    values.append(v.astype(np.float32).tobytes())
                else:
                    slots.append(None)
                    values.append(None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(slots, pa.binary()),
                    pa.array(values, pa.binary()),
                    pa.array([n for n, _, _ in found], pa.int64()),
                    *(pa.array([v[name] for _, v, _ in found], pa.float64()) for name in MEASURES),
                    *(pa.array([k in lists for _, _, lists in found], pa.bool_()) for k in range(3)),
                ],
                names=["hash", "slots", "values", "n_words", *MEASURES, *(f"terms_{k}" for k in range(3))],
            )

    columns = ["hash bigint", "slots binary", "values binary", "n_words bigint", *(f"{m} double" for m in MEASURES)]
    columns += [f"terms_{k} boolean" for k in range(3)]
    return rows.select(hashed.alias("hash"), "text").mapInArrow(work, ", ".join(columns))


def quality_labellers() -> list[Labeller]:
    c, long = F.col, F.col("n_words") >= 30
    return [
        Labeller("symbols", c("odd") < 0.02, c("odd") > 0.05),
        Labeller("capitals", c("capitals") < 0.2, c("capitals") > 0.5),
        Labeller("variety", long & (c("distinct") > 0.45), long & (c("distinct") < 0.3)),
        Labeller("repeats", c("again") < 0.05, long & (c("again") > 0.2)),
        Labeller("function_words", c("common") > 0.12, long & (c("common") < 0.04)),
        Labeller("sentences", c("stops").between(0.02, 0.35), long & ((c("stops") < 0.005) | (c("stops") > 0.6))),
        Labeller("letters", c("letters") > 0.72, c("letters") < 0.6),
        Labeller("word_length", c("word_chars").between(2.5, 9), (c("word_chars") < 1.5) | (c("word_chars") > 14)),
    ]


def decency_labellers() -> list[Labeller]:
    """Three word lists without a common word: any of its words is a bad sign, none is a good one."""
    return [Labeller(f"terms_{k}", ~F.col(f"terms_{k}"), F.col(f"terms_{k}")) for k in range(3)]


def unwanted_terms(docs: DataFrame, labels: DataFrame, size: int = LABELLED) -> list[str]:
    """Words that labelled toxic documents hold far more often than others, the most telling first.

    Learned from at most about ``size`` labelled documents with different texts; a word, or its first ``STEM``
    letters, counts once a document. Of several texts under one id the one of least hash counts, of several
    labels of one text or id the worst.
    """
    marked = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = marked.count()
    if not n:
        return []
    some = marked.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int((1 << 20) * min(1.0, size / n)))
    words = with_stems(F.transform(F.split(F.lower("text"), BREAKS), lambda w: F.regexp_replace(w, r"[^\p{L}]+", "")))
    found = docs.filter("text is not null").join(some, "doc_id")
    one = found.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text"), "text")).text.alias("text"), F.max("toxic").alias("toxic"))
    found = one.groupBy("text").agg(F.max("toxic").alias("toxic"))
    chosen = stored(found.select("toxic", words.alias("words")), "labelled")
    total = {r.toxic: r["count"] for r in chosen.groupBy("toxic").count().collect()}
    bad, good = total.get(1, 0), total.get(0, 0)
    counts = (
        chosen.select(F.explode("words").alias("word"), "toxic")
        .filter("word <> ''")
        .groupBy("word")
        .agg(F.sum((F.col("toxic") == 1).cast("long")).alias("a"), F.sum((F.col("toxic") == 0).cast("long")).alias("b"))
    )
    odds = (F.col("a") / max(bad, 1)) / ((F.col("b") + 0.5) / max(good, 1))
    enough = max(5, bad // 150)
    telling = counts.filter((F.col("a") >= enough) & (odds >= 25)).orderBy(F.desc("a"), "word")
    return [r.word for r in telling.collect()]


def estimate(patterns: list[tuple[tuple[int, ...], int]], rounds: int = ROUNDS) -> tuple[list[float], np.ndarray, float]:
    """Probability that each vote pattern is of a good row, each labeller's accuracy by class, and the share of good rows.

    Expectation-maximisation over (pattern, number of rows). Votes are 1 (good), -1 (bad) or 0, which says
    nothing; given its class, a row's votes are taken as independent. It starts from labellers that
    seldom call a good row bad and often miss a bad one, and keeps that belief as a few
    rows' worth of evidence, which settles which class is which.
    """
    votes = np.array([p for p, _ in patterns], int).reshape(len(patterns), -1)
    weight = np.array([n for _, n in patterns], float)
    start = np.array([[0.45], [0.97]]).repeat(votes.shape[1], axis=1)  # accuracy on bad rows, on good rows
    evidence = 0.002 * weight.sum() + 1
    accuracy, share = start.copy(), 0.8
    good = np.full(len(patterns), 0.5)
    for _ in range(rounds):
        # log odds that a good vote, and a bad one, give for a good row
        plus, minus = np.log(accuracy[1] / (1 - accuracy[0])), np.log((1 - accuracy[1]) / accuracy[0])
        odds = (votes == 1) @ plus + (votes == -1) @ minus + np.log(share / (1 - share))
        good = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        for c, belief, right in ((0, 1 - good, votes == -1), (1, good, votes == 1)):
            cast = (belief * weight) @ (votes != 0)
            accuracy[c] = ((belief * weight) @ right + evidence * start[c]) / (cast + evidence)
        accuracy = np.clip(accuracy, 1e-6, 1 - 1e-6)
        share = float(np.clip((good * weight).sum() / max(weight.sum(), 1), 0.01, 0.99))
    return good.tolist(), accuracy, share


def _shape(word: str) -> str:
    """The kinds of characters in a word, runs as one: 'Word,' is 'Aa,'."""
    kinds = ("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word)
    out = ""
    for c in kinds:
        if not out or out[-1] != c:
            out += c
    return out


def features(text: str, shapes: dict[str, str]) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values of a text: its words, their shapes, and words that follow themselves, each hashed.

    A slot's value is the square root of its share of the text's words, or of ``LONG`` words if there are more, 1 at most.
    """
    words = text.split()
    keys = [*words]
    previous = None
    for w in words:
        if w not in shapes:
            if len(shapes) > 100_000:
                shapes.clear()
            shapes[w] = "\0" + _shape(w)
        keys.append(shapes[w])
        if w == previous:
            keys.append("\1again")
        previous = w
    counts: dict[str, int] = {}
    for key in keys:
        counts[key] = counts.get(key, 0) + 1
    digest = xxhash.xxh64_intdigest
    folded: dict[int, int] = {}
    for key, n in counts.items():
        slot = digest(key if key[0] < "\2" else key.lower().strip(".,;:!?\"'()"), 5) % SLOTS
        folded[slot] = folded.get(slot, 0) + n
    slots = np.fromiter(folded, np.int64, len(folded))
    values = np.sqrt(np.fromiter(folded.values(), np.float64, len(folded)) / max(min(len(words), LONG), 1))
    return slots, np.minimum(values, 1.0)


class Weights:
    """A weight for each slot, 0 for most: only the others are kept."""

    def __init__(self, slots: np.ndarray, values: np.ndarray):
        self.slots = np.append(slots, SLOTS)  # sorted, with an end that no slot reaches
        self.values = np.append(values, 0.0)

    def __getitem__(self, slots: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.slots, slots)
        return np.where(self.slots[at] == slots, self.values[at], 0.0)


def fit(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray) -> tuple[Weights, float]:
    """Weights and offset of a logistic scorer of soft labels; the rarer class weighs more, as much as it is rarer."""
    if not rows:
        return Weights(np.zeros(0, np.int64), np.zeros(0)), 0.0
    sizes = np.array([len(s) for s, _ in rows])
    slots = np.concatenate([s for s, _ in rows])
    values = np.concatenate([v for _, v in rows])
    owner = np.repeat(np.arange(len(rows), dtype=np.int32), sizes)
    often = np.bincount(slots, minlength=SLOTS)
    used = np.flatnonzero(often >= SEEN)
    keep = often[slots] >= SEEN
    slots, values, owner = slots[keep], values[keep], owner[keep]
    place = np.searchsorted(used, slots).astype(np.int32)
    del often, keep, slots
    rare = np.clip(len(target) / (2 * max(min(target.sum(), (1 - target).sum()), 1.0)), 1, 10)
    importance = 1 + (rare - 1) * np.abs(target - (target.mean() >= 0.5))
    importance /= importance.sum()

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        z = np.bincount(owner, w[place] * values, minlength=len(rows)) + w[-1]
        value = importance @ (np.logaddexp(0, z) - target * z) + 0.5 * RIDGE * (w[:-1] @ w[:-1])
        error = importance * (1 / (1 + np.exp(-np.clip(z, -500, 500))) - target)
        slope = np.bincount(place, error[owner] * values, minlength=len(w))
        slope[:-1] += RIDGE * w[:-1]
        slope[-1] = error.sum()
        return float(value), slope

    found = _minimum(loss, np.zeros(len(used) + 1))
    seen = found[:-1] != 0
    return Weights(used[seen], found[:-1][seen]), float(found[-1])


def _minimum(loss, start: np.ndarray, memory: int = 8) -> np.ndarray:
    """Limited-memory quasi-Newton descent with halved steps."""
    at, (value, slope) = start, loss(start)
    pairs: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(PASSES):
        way, shares = slope.copy(), []
        for s, y, r in reversed(pairs):
            shares.append(r * (s @ way))
            way -= shares[-1] * y
        if pairs:
            s, y, _ = pairs[-1]
            way *= (s @ y) / (y @ y)
        for (s, y, r), share in zip(pairs, reversed(shares), strict=True):
            way += (share - r * (y @ way)) * s
        step, gain = 1.0, slope @ way
        while step > 1e-6:
            there = at - step * way
            there_value, there_slope = loss(there)
            if there_value <= value - 1e-4 * step * gain:
                break
            step /= 2
        else:
            return at
        s, y = there - at, there_slope - slope
        if s @ y > 1e-12:
            pairs = [*pairs[1 - memory :], (s, y, 1 / (s @ y))]
        if value - there_value < 1e-6 * value:
            return there
        at, value, slope = there, there_value, there_slope
    return at


@dataclass(frozen=True)
class Scorers:
    """A linear scorer for each question, and what was learned of the labellers on the way."""

    quality: tuple[Weights, float]
    decency: tuple[Weights, float]
    terms: list[str]
    accuracies: dict[str, np.ndarray]


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Scorers:
    """Scorers of quality and decency, from heuristics that vote on every document.

    All documents' votes are counted by pattern, at most 3 to the power of the labellers. The scorers are
    fitted on about ``sample`` documents, chosen by a hash of id and text, to the probabilities of their patterns. Each text is read once; of rows that repeat in full one may be fitted on, and all are counted.
    ``labels`` (``doc_id``, ``toxic``) only serves to find the words that the decency labellers look for.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    terms = unwanted_terms(rows, labels)
    groups = {"quality": quality_labellers(), "decency": decency_labellers()}
    n = rows.count()
    seen = measured(rows, terms, sample / max(n, 1))
    names = [x.name for group in groups.values() for x in group]
    hashes = F.expr("nvl2(slots, hash, null) AS hash")
    votes = stored(seen.select(hashes, "slots", "values", *(x.vote for group in groups.values() for x in group)), "votes")
    counts = votes.groupBy(*names).count().collect()
    found = sorted(votes.filter("slots is not null").dropDuplicates(["hash"]).collect(), key=operator.itemgetter("hash"))
    vectors = [(np.frombuffer(r.slots, np.int32), np.frombuffer(r["values"], np.float32)) for r in found]
    fits, tables = {}, {}
    for question, group in groups.items():
        own = [x.name for x in group]
        merged: dict[tuple[int, ...], int] = {}
        for r in counts:
            key = tuple(r[c] for c in own)
            merged[key] = merged.get(key, 0) + r["count"]
        patterns = sorted(merged.items())
        good, tables[question], _ = estimate(patterns) if patterns else ([], np.zeros(0), 0.0)
        chance = {p: g for (p, _), g in zip(patterns, good, strict=True)}
        fits[question] = fit(vectors, np.array([chance[tuple(r[c] for c in own)] for r in found]))
    return Scorers(fits["quality"], fits["decency"], terms, tables)


def score(docs: DataFrame, scorers: Scorers, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's ``doc_id``, ``quality`` and ``decency`` (0 to 1) and ``keep`` (both at least 0.5).

    Null and empty texts have no features: both scores are 0 and they are not kept. Repeated
    rows get equal scores; a null id is scored like others. A text of any length is read whole, one at a
    time; other columns are left out. An empty table gives no rows.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast([scorers.quality, scorers.decency])
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes: dict[str, str] = {}
        for batch in batches:
            scores = np.zeros((2, batch.num_rows))
            for n, raw in enumerate(texts_of(batch.column(1))):
                slots, values = features(raw.decode("utf-8", "replace"), shapes)
                if len(slots):
                    for k, (weights, offset) in enumerate(shared.value):
                        scores[k, n] = 1 / (1 + np.exp(-np.clip(weights[slots] @ values + offset, -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores[0]), pa.array(scores[1]), pa.array((scores >= 0.5).all(axis=0))],
                names=["doc_id", "quality", "decency", "keep"],
            )

    return rows.mapInArrow(work, f"doc_id {kind}, quality double, decency double, keep boolean")
