"""Language identification by bit-sliced Bloom filters over character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peneira.llm.common import code_points, in_chunks, mixed, stored, texts_of

RARE = 1e-5  # share of a language's n-grams from which on one belongs to its filter
HASHES = 3
SLOTS_PER_GRAM = 16
UNKNOWN = "und"
WORD = 64  # languages per word of a slot


_CACHE: dict[str, np.ndarray] = {}


def _letters() -> np.ndarray:
    """For each code point, whether it is a letter; made once in a process."""
    if "letters" not in _CACHE:
        _CACHE["letters"] = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _CACHE["letters"]


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The 3-grams of all texts as numbers, the text each belongs to, and which texts have a letter.

    Texts are lower-cased; everything but letters counts as a blank, and runs of
    blanks are one, so that a word's ends show. A 3-gram never spans two texts.
    """
    lowered = [t.lower() for t in texts]
    points = code_points("  ".join(["", *lowered, ""]))
    owner = np.repeat(np.arange(len(texts)), [len(t) + 2 for t in lowered])
    owner = np.concatenate([owner[:1].repeat(2) if len(owner) else np.zeros(2, int), owner])
    letter = _letters()[points]
    has_letter = np.bincount(owner[letter], minlength=len(texts)) > 0
    solid = letter.copy()
    solid[1:] |= letter[:-1]  # of each run of blanks, the first stays
    points, owner = np.where(letter, points, 32)[solid].astype(np.uint64), owner[solid]
    if len(points) < 3:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), has_letter
    # A blank goes before a text's first letter, too: its n-grams begin as those of any word.
    first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    points, owner = np.insert(points, first, 32), np.insert(owner, first, owner[first])
    grams = (points[:-2] << np.uint64(42)) | (points[1:-1] << np.uint64(21)) | points[2:]
    return grams[whole := owner[:-2] == owner[2:]], owner[:-2][whole], has_letter


def gram_counts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """``lang``, ``gram``, ``n``: how often each 3-gram occurs in each language's texts.

    Tasks add up what they read before the shuffle; the result has the distinct
    n-grams of each language, however many texts there are.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        waiting = 0

        def added() -> Iterator[pa.RecordBatch]:
            for name, parts in held.items():
                grams, at = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
                n = np.bincount(at, np.concatenate([c for _, c in parts])).astype(np.int64)
                yield pa.RecordBatch.from_pydict({"lang": [name] * len(grams), "gram": grams.view(np.int64), "n": n})

        for batch in batches:
            texts, langs = texts_of(batch.column(0)), batch.column(1).to_pylist()
            for name in set(langs):
                own = [t.decode("utf-8", "replace") for t, x in zip(texts, langs, strict=True) if x == name]
                for run in in_chunks([len(t) for t in own]):
                    counted = np.unique(trigrams(own[run])[0], return_counts=True)
                    held.setdefault(name, []).append(counted)
                    waiting += len(counted[0])
            if waiting > 1 << 22:
                yield from added()
                held, waiting = {}, 0
        yield from added()

    rows = docs.filter(F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    counted = rows.mapInArrow(work, "lang string, gram bigint, n bigint")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class LanguageFilters:
    """Bit-sliced Bloom filters: slot i holds one bit for each language.

    ``slots[h(gram)]`` over all hashes, joined by AND, is the set of languages whose
    filter has the n-gram. ``false_rate`` is, for each language, how often an n-gram
    that was never put in shows up all the same: its share of set slots to the power
    of the number of hashes.
    """

    languages: list[str]
    slots: np.ndarray  # (slots, words), a power of two of slots
    false_rate: np.ndarray
    default: str  # of texts with letters but no known n-gram

    def masks(self, grams: np.ndarray) -> np.ndarray:
        low = np.uint64(len(self.slots) - 1)
        found = self.slots[(mixed(grams, 0) & low).astype(np.int64)]
        for seed in range(1, HASHES):
            found &= self.slots[(mixed(grams, seed) & low).astype(np.int64)]
        return found

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """Language and score of each text, see ``identify``."""
        grams, owner, has_letter = trigrams(texts)
        masks = self.masks(grams)
        total = np.bincount(owner, minlength=len(texts))
        shares = np.zeros((len(self.languages), len(texts)))
        for k, rate in enumerate(self.false_rate):
            bits = (masks[:, k // WORD] >> np.uint64(k % WORD)) & np.uint64(1)
            hits = np.bincount(owner, bits, minlength=len(texts))
            shares[k] = np.clip((hits - total * rate) / np.maximum(total, 1) / (1 - rate), 0, 1)
        if not self.languages:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        best, score = shares.argmax(axis=0), shares.max(axis=0)
        names = [
            UNKNOWN if not letter else self.languages[b] if s > 0 else self.default
            for letter, b, s in zip(has_letter, best, score, strict=True)
        ]
        return names, np.where(has_letter, score, 0.0).tolist()


def learn_filters(docs: DataFrame, text: str = "text", lang: str = "lang", rare: float = RARE) -> LanguageFilters:
    """Filters from the texts that have a language; rows with a null language are passed over.

    An n-gram belongs to a language if it makes up at least ``rare`` of the
    n-grams of its texts, so at most 1 / ``rare`` per language reach the driver,
    whatever the number of texts. Ties in the score go to the first language by name.
    """
    counts = stored(gram_counts(docs, text, lang), "grams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    frequent = counts.join(F.broadcast(totals), "lang").filter(F.col("n") >= F.col("total") * rare)
    kept = frequent.select("lang", "gram").toArrow()
    sizes = {r.lang: r.total for r in totals.collect()}
    languages = sorted(sizes)
    rank = {name: k for k, name in enumerate(languages)}
    of = np.array([rank[x] for x in kept.column("lang").to_pylist()], np.int64)
    grams = kept.column("gram").to_numpy().astype(np.int64).view(np.uint64)
    most = max(np.bincount(of).max(initial=1), 64)
    slots = np.zeros((1 << int(most * SLOTS_PER_GRAM - 1).bit_length(), len(languages) // WORD + 1), np.uint64)
    low = np.uint64(len(slots) - 1)
    for seed in range(HASHES):
        at = (mixed(grams, seed) & low).astype(np.int64)
        np.bitwise_or.at(slots, (at, of // WORD), np.uint64(1) << (of % WORD).astype(np.uint64))
    rates = [
        (((slots[:, k // WORD] >> np.uint64(k % WORD)) & np.uint64(1)).mean()) ** HASHES for k in range(len(languages))
    ]
    default = max(languages, key=lambda name: (sizes[name], name), default=UNKNOWN)
    return LanguageFilters(languages, slots, np.array(rates), default)


def _predictor(spark, filters: LanguageFilters):
    shared = spark.sparkContext.broadcast(vars(filters))  # plain values: a broadcast is not pickled with its class

    def predict(column: pa.Array) -> tuple[list[str], list[float]]:
        names: list[str] = []
        scores: list[float] = []
        texts = [t.decode("utf-8", "replace") for t in texts_of(column)]
        own = LanguageFilters(**shared.value)
        for run in in_chunks([len(t) for t in texts]):
            some = own.predict(texts[run])
            names += some[0]
            scores += some[1]
        return names, scores

    return predict


def identify(docs: DataFrame, filters: LanguageFilters, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns in ``keep`` with ``lang_pred`` and ``score`` of every row, from the whole text alone.

    The score is the share of the text's n-grams that the language's filter holds,
    less the hits that false positives would give. ``und`` with score 0: null texts,
    texts without a letter, or filters learned from no text. Texts of letters that
    no filter knows get the language with the most training text, with score 0.
    """
    keep = ["doc_id"] if keep is None else keep
    predict = _predictor(docs.sparkSession, filters)
    rows = docs.select(F.col(text).alias("__text"), *keep)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = predict(batch.column(0))
            rest = batch.columns[1:]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[*keep, "lang_pred", "score"]
            )

    schema = rows.drop("__text").schema.add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(work, schema)


def keep_known(docs: DataFrame, filters: LanguageFilters, text: str = "text", least: float = 0.2) -> DataFrame:
    """The rows whose language is known with a score of ``least`` or more, columns unchanged."""
    predict = _predictor(docs.sparkSession, filters)
    place = docs.columns.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = predict(batch.column(place))
            yield batch.filter(pa.array([n != UNKNOWN and s >= least for n, s in zip(names, scores, strict=True)], pa.bool_()))

    return docs.mapInArrow(work, docs.schema)
