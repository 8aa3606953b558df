"""A bigram trie in Elias-Fano code, and language-model scores of documents from it."""

from __future__ import annotations

import struct
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peneira.llm.common import partitions, sorted_groups, stored, texts_of
from peneira.llm.token_codes import Codes, encode_codes

END = b"\n"  # the end token, and the context of a text's first word; no word holds a line break
WEIGHT = 5.0  # of the single-word probability among the counts after a word
CODES = 255  # levels that probabilities are quantised to; one more code says that a word never follows
BUNDLE_TOKENS = 1 << 21  # tokens whose bigrams are counted together before they are sent off
SHARD_BYTES = 8 << 20  # of text for each shard of the trie
WORD_BITS = 48  # of a successor's hash


class EliasFano:
    """Numbers in ascending order in about 2 + log2(largest / count) bits each, read in place.

    The low bits of every number are packed; the high bits are a bitmap with a one for each number
    after as many zeros as its high part is. A directory of ones before every 512 bits finds
    the i-th one or zero. All operations take arrays of queries.
    """

    HEAD = "<QQQQ"

    def __init__(self, image: memoryview | bytes, at: int = 0):
        self.n, self.low_bits, low_bytes, words = struct.unpack_from(self.HEAD, image, at)
        at += struct.calcsize(self.HEAD)
        raw = np.frombuffer(image, np.uint8, low_bytes, at)
        self._low = np.ndarray((low_bytes - 7,), "<u8", raw.data, strides=(1,))
        at += low_bytes
        self._high = np.frombuffer(image, "<u8", words, at)
        at += words * 8
        self._ones = np.frombuffer(image, "<u4", words // 8 + 1, at).astype(np.int64)
        self._zeros = np.arange(words // 8 + 1) * 512 - self._ones
        self.end = at + (words // 8 + 1) * 4

    @classmethod
    def image(cls, values: np.ndarray) -> bytes:
        """The bytes that hold these ascending numbers; they may repeat."""
        values = values.astype(np.uint64)
        n = len(values)
        largest = int(values[-1]) if n else 0
        low_bits = min(max((largest // n).bit_length() - 1, 0), 56) if n else 0
        low = bytearray(-(-n * low_bits // 8) + 8)
        for start in range(0, n, 1 << 18):  # a multiple of 8 numbers: each run starts at a byte
            run = values[start : start + (1 << 18)]
            bits = (run[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
            packed = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()
            low[start * low_bits // 8 : start * low_bits // 8 + len(packed)] = packed
        place = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        size = (largest >> low_bits) + n + 1
        words = -(-size // 512) * 8
        bitmap = np.zeros(words * 64, np.uint8)
        bitmap[place] = 1
        ones = np.r_[0, np.cumsum(bitmap.reshape(-1, 512).sum(axis=1))].astype("<u4")
        head = struct.pack(cls.HEAD, n, low_bits, len(low), words)
        return head + bytes(low) + np.packbits(bitmap, bitorder="little").tobytes() + ones.tobytes()

    def _select(self, k: np.ndarray, ones: bool) -> np.ndarray:
        """Place of the k-th (from 0) one or zero of the bitmap."""
        before = self._ones if ones else self._zeros
        block = np.searchsorted(before, k, "right") - 1
        rest = (k - before[block]).astype(np.int64)
        word = block * 8
        done = np.zeros(len(k), bool)
        for _ in range(7):
            bits = np.bitwise_count(self._high[word] if ones else ~self._high[word]).astype(np.int64)
            on = ~done & (rest >= bits)
            done |= ~on
            rest -= np.where(on, bits, 0)
            word += on
        value = self._high[word] if ones else ~self._high[word]
        place = np.zeros(len(k), np.int64)
        for half in (32, 16, 8, 4, 2, 1):
            bits = np.bitwise_count(value & np.uint64((1 << half) - 1)).astype(np.int64)
            on = rest >= bits
            rest -= np.where(on, bits, 0)
            place += on * half
            value = np.where(on, value >> np.uint64(half), value)
        return word * 64 + place

    def _low_of(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        bit = i * self.low_bits
        return (self._low[bit >> 3] >> (bit & 7).astype(np.uint64)) & np.uint64((1 << self.low_bits) - 1)

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        """The i-th numbers."""
        high = (self._select(i, True) - i).astype(np.uint64)
        return (high << np.uint64(self.low_bits)) | self._low_of(i)

    def successor(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each value, the place of the first number not below it, and whether it is the value itself."""
        values = values.astype(np.uint64)
        if not self.n:
            return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
        high = (values >> np.uint64(self.low_bits)).astype(np.int64)
        low = values & np.uint64((1 << self.low_bits) - 1)
        beyond = high >= self._zeros[-1]
        place = np.zeros(len(values), np.int64)  # in the bitmap: where the numbers of this high part start
        some = np.flatnonzero((high > 0) & ~beyond)
        place[some] = self._select(high[some] - 1, False) + 1
        i = np.where(beyond, self.n, place - high)
        same = np.zeros(len(values), bool)
        active = np.flatnonzero(~beyond)
        while len(active):
            at = place[active]
            active = active[(self._high[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) > 0]
            own = self._low_of(i[active])
            same[active[own == low[active]]] = True
            active = active[own < low[active]]
            i[active] += 1
            place[active] += 1
        return i, same


def trie_image(context: np.ndarray, successor: np.ndarray, count: np.ndarray) -> bytes:
    """The file image of a shard's trie, from its bigrams (no pair twice) and their counts.

    Level 1: the contexts' hashes, how often each occurs, and monotone pointers to its successors.
    Level 2: for each context its successors, as ranks among the shard's successors; each context's
    ranks are raised by where the last context's end, which makes the level one ascending
    sequence. Beside them the quantised probabilities count / (occurrences + ``WEIGHT``).
    """
    if not (ordered := (context[1:] > context[:-1]) | ((context[1:] == context[:-1]) & (successor[1:] > successor[:-1]))).all():
        order = np.lexsort((successor, context))
        context, successor, count = context[order], successor[order], count[order]
    del ordered
    contexts, first, sizes = np.unique(context, return_index=True, return_counts=True)
    words, rank = np.unique(successor, return_inverse=True)
    totals = np.add.reduceat(count, first) if len(first) else np.zeros(0, np.int64)
    ends = np.r_[first, len(context)]
    last = rank[ends[1:] - 1] + 1 if len(first) else np.zeros(0, np.int64)
    raised = np.cumsum(last) - last  # where each context's ranks start
    level = rank + np.repeat(raised, sizes)
    chance = np.log10(count / (np.repeat(totals, sizes) + WEIGHT))
    codes, book = quantised(chance)
    parts = [
        EliasFano.image(contexts),
        EliasFano.image(ends),
        EliasFano.image(np.r_[raised, raised[-1] + last[-1]] if len(first) else np.zeros(1)),
        EliasFano.image(words),
        EliasFano.image(level),
        totals.astype("<u8").tobytes(),
        book.astype("<f8").tobytes(),
        codes.tobytes(),
    ]
    return struct.pack("<8Q", *map(len, parts)) + b"".join(parts)


def quantised(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A code of 8 bits for each value and the value of each code: the means of bins.

    Half of the bounds make the bins equally full, half equally wide, so that no value is far from its bin's mean.
    """
    book = np.zeros(CODES)
    if not len(values):
        return np.zeros(0, np.uint8), book
    half = CODES // 2
    full = np.quantile(values, np.arange(1, half) / half)
    bounds = np.unique(np.concatenate([full, np.linspace(values.min(), values.max(), half + 1)[1:]]))
    codes = np.searchsorted(bounds, values, "right").astype(np.uint8)  # at most CODES - 1 bounds
    full = np.bincount(codes, minlength=CODES)
    book[full > 0] = np.bincount(codes, values, minlength=CODES)[full > 0] / full[full > 0]
    return codes, book


class Trie:
    """Look-ups in a file image, which may be mapped into memory: nothing but the rank directories is decoded."""

    def __init__(self, image: memoryview | bytes):
        sizes = struct.unpack_from("<8Q", image, 0)
        starts = np.r_[64, 64 + np.cumsum(sizes)].tolist()
        self.contexts, self.pointers, self.raised, self.words, self.level = (EliasFano(image, s) for s in starts[:5])
        self.totals = np.frombuffer(image, "<u8", sizes[5] // 8, starts[5])
        self.book = np.frombuffer(image, "<f8", CODES, starts[6])
        self.codes = np.frombuffer(image, np.uint8, sizes[7], starts[7])

    def find(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each hash, the context's number (-1 if there is none) and how often it occurs."""
        i, same = self.contexts.successor(context)
        number = np.where(same, i, -1)
        totals = np.zeros(len(context), np.int64)
        totals[same] = self.totals[i[same]].astype(np.int64)
        return number, totals

    def follow(self, number: np.ndarray, successor: np.ndarray) -> np.ndarray:
        """The code of each successor's probability after its context, or ``CODES`` if it never follows.

        The successor becomes its rank, the rank is raised by the context's start, and the search for it
        must end within the context's pointers.
        """
        words, at = np.unique(successor, return_inverse=True)
        rank, known = self.words.successor(words)
        return self.follow_ranks(number, rank[at], known[at])

    def follow_ranks(self, number: np.ndarray, rank: np.ndarray, known: np.ndarray) -> np.ndarray:
        """``follow`` for successors whose rank has been looked up."""
        result = np.full(len(number), CODES, np.uint8)
        asked = np.flatnonzero(known & (number >= 0))
        contexts, own = np.unique(number[asked], return_inverse=True)
        start, low, high = self.raised[contexts], self.pointers[contexts].astype(np.int64), self.pointers[contexts + 1].astype(np.int64)
        i, same = self.level.successor(rank[asked].astype(np.uint64) + start[own])
        inside = same & (i >= low[own]) & (i < high[own])
        result[asked[inside]] = self.codes[i[inside]]
        return result


# --- the corpus -------------------------------------------------------------------------------------


def words_of(text: bytes) -> list[bytes]:
    """The words of a text with A-Z lower-cased (``bytes.lower`` and ``split`` know ASCII alone), and its end."""
    return [*text.lower().split(), END]


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, 11)


def frequent_words(docs: DataFrame, shards: int) -> dict[int, int]:
    """Words that are more than a quarter of a shard's fair part of all tokens, with the slices for their successors.

    Each task reports the words that reach that part of its own batch, at most four times the shards,
    so the list is bounded by the number of shards. A word has slices in proportion to its part of all tokens, up to
    all shards. The list decides on where counts are kept, not on any result.
    """
    least = 1 / (4 * shards)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = Counter()
            for text in texts_of(batch.column(0)):
                counts.update(words_of(text))
            total = sum(counts.values())
            often = [(word_hash(w), n) for w, n in counts.items() if n >= least * total]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.array([0, *(h for h, _ in often)], np.uint64).view(np.int64)),
                    pa.array([total, *(n for _, n in often)], pa.int64()),
                    pa.array([True] + [False] * len(often)),
                ],
                names=["word", "n", "all"],
            )

    found = docs.select("text").mapInArrow(work, "word long, n long, all boolean").groupBy("word", "all").agg(F.sum("n").alias("n"))
    found = stored(found, "frequent")
    total = found.filter("all").agg(F.sum("n")).first()[0] or 0
    rows = found.filter(~F.col("all") & (F.col("n") >= least * total)).collect() if total else []
    return {r.word & (1 << 64) - 1: 1 << (4 * shards * r.n // total).bit_length() for r in rows}


def _places(
    v: np.ndarray, w: np.ndarray, home: np.ndarray, part: np.ndarray, slices: np.ndarray, shards: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shard of each bigram (v, w), and the (context, shard) entries, sorted by shard, then context.

    A word's bigrams are kept in its home shard, those of a frequent word in as many shards as it has slices,
    by as many bytes of the successor's hash as number all shards.
    """
    shard = (home[v] + part[w] % slices[v]) % shards
    many = np.flatnonzero(slices > 1)
    one = np.flatnonzero(slices == 1)
    local = np.concatenate([one, *(np.full(int(slices[m]), m) for m in many)])
    at = np.concatenate([home[one], *((home[m] + np.arange(int(slices[m]))) % shards for m in many)])
    order = np.lexsort((local, at))
    return shard, local[order], at[order]


def _packed(numbers: np.ndarray) -> bytes:
    """Small numbers in directly addressable codes: about a byte each."""
    return encode_codes(numbers)


def _unpacked(raw: bytes) -> np.ndarray:
    codes = Codes(raw)
    return codes.read(0, len(codes)).astype(np.int64)


BUNDLE = "bundle long, shard int, doc_ids array<bigint>, held_out array<boolean>, data binary"


def _bundle(
    number: int, names: list, held: list[bool], texts: list[np.ndarray], known: dict[bytes, int],
    frequent: dict[int, int], shards: int,
) -> pa.RecordBatch:
    """Rows of one bundle: its documents as word numbers (shard -1), and for each shard the bigrams it needs to know of.

    ``texts`` has the words of each text, numbered by ``known``.
    """
    ids = np.concatenate(texts).astype(np.int64)
    hashes = np.fromiter(map(word_hash, known), np.uint64, len(known))
    home = (hashes % np.uint64(shards)).astype(np.int64)
    width = np.min_scalar_type(shards - 1)
    part = (hashes >> np.uint64(32)).astype(width).astype(np.int64)
    slices = np.array([min(frequent.get(h, 1), shards) for h in hashes.tolist()], np.int64)
    sizes = np.array([len(w) for w in texts], np.int64)
    trained = np.repeat(~np.array(held, bool), sizes)
    v, w = _bigrams(ids, known[END])
    pair = v * len(hashes) + w
    pairs, at = np.unique(pair, return_inverse=True)
    count = np.bincount(at, trained, minlength=len(pairs)).astype(np.int64)
    pv, pw = pairs // len(hashes), pairs % len(hashes)
    shard, entry, entry_shard = _places(pv, pw, home, part, slices, shards)
    by_shard = np.argsort(shard, kind="stable")
    cuts = np.searchsorted(shard[by_shard], np.arange(shards + 1))
    entry_cuts = np.searchsorted(entry_shard, np.arange(shards + 1))
    rows: list[tuple] = []
    tail = (hashes >> np.uint64(64 - WORD_BITS)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, : WORD_BITS // 8]
    for s in range(shards):
        own, places = entry[entry_cuts[s] : entry_cuts[s + 1]], by_shard[cuts[s] : cuts[s + 1]]
        if len(own):
            follow = np.searchsorted(pv[places], own, "right") - np.searchsorted(pv[places], own, "left")
            rows.append((s, _pack_parts([hashes[own].tobytes(), _packed(follow), tail[pw[places]].tobytes(), _packed(count[places])])))
    fixed = [np.stack([part, slices - 1]).astype(width).tobytes(), struct.pack("<q", known[END])]
    documents = _pack_parts([_packed(ids), _packed(sizes), _packed(home), *fixed])
    n = len(rows)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([number] * (n + 1), pa.int64()),
            pa.array([-1, *(s for s, _ in rows)], pa.int32()),
            pa.array([names, *[None] * n], pa.list_(pa.int64())),
            pa.array([held, *[None] * n], pa.list_(pa.bool_())),
            pa.array([documents, *(d for _, d in rows)], pa.binary()),
        ],
        names=["bundle", "shard", "doc_ids", "held_out", "data"],
    )


def _bigrams(ids: np.ndarray, known_end: int) -> tuple[np.ndarray, np.ndarray]:
    """Each token's context and the token; the end token stands before the first word of every text."""
    return np.r_[known_end, ids[:-1]], ids


def _pack_parts(parts: list[bytes]) -> bytes:
    return struct.pack(f"<{len(parts) + 1}Q", len(parts), *map(len, parts)) + b"".join(parts)


def _parts(raw: bytes) -> list[bytes]:
    (n,) = struct.unpack_from("<Q", raw)
    sizes, at, parts = struct.unpack_from(f"<{n}Q", raw, 8), 8 + 8 * n, []
    for size in sizes:
        parts.append(raw[at : at + size])
        at += size
    return parts


def bundles(docs: DataFrame, frequent: dict[int, int], shards: int, most: int = BUNDLE_TOKENS) -> DataFrame:
    """The documents in bundles of about ``most`` tokens, each bundle's bigrams counted once and dealt to shards."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        names, held, texts, known, waiting = [], [], [], {}, 0
        for batch in batches:
            columns = (batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts_of(batch.column(2)))
            for name, out, text in zip(*columns, strict=True):
                ids = np.array([known.setdefault(w, len(known)) for w in words_of(text)], np.int32)
                names.append(name)
                held.append(out)
                texts.append(ids)
                waiting += len(ids)
                if waiting >= most:
                    yield _bundle(number, names, held, texts, known, shared.value, shards)
                    number += 1
                    names, held, texts, known, waiting = [], [], [], {}, 0
        if texts:
            yield _bundle(number, names, held, texts, known, shared.value, shards)

    return docs.mapInArrow(work, BUNDLE)


ANSWER = f"{BUNDLE}, trie binary, tokens long, words long"


def _successors(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // (WORD_BITS // 8), 8), np.uint8)
    wide[:, : WORD_BITS // 8] = np.frombuffer(raw, np.uint8).reshape(-1, WORD_BITS // 8)
    return wide.view("<u8").ravel()


def _answers(group: pa.Table, frequent: dict[int, int]) -> tuple[bytes, int, np.ndarray, list[tuple[int, bytes]]]:
    """Builds a shard's trie from all bundles' counts and answers each bundle's bigrams from it.

    Result: the trie's image, the tokens it counts, its contexts, and each bundle's answer.
    """
    asked = []
    for b, raw in zip(group.column("bundle").to_pylist(), group.column("data").to_pylist(), strict=True):
        hashes, follow, words, count = _parts(raw)
        asked.append((b, np.frombuffer(hashes, np.uint64), _unpacked(follow), _successors(words), _unpacked(count)))
    # Each context, word and bigram that any bundle asks for, once and in order.
    contexts, place = np.unique(np.concatenate([h for _, h, *_ in asked]), return_inverse=True)
    words, word = np.unique(np.concatenate([w for _, _, _, w, _ in asked]), return_inverse=True)
    pair = np.repeat(place, np.concatenate([f for _, _, f, *_ in asked])) * len(words) + word
    pairs, at = np.unique(pair, return_inverse=True)
    del pair, word
    count = np.bincount(at, np.concatenate([c for *_, c in asked]), minlength=len(pairs)).astype(np.int64)
    context, word = pairs // max(len(words), 1), pairs % max(len(words), 1)
    seen = count > 0
    image = trie_image(contexts[context[seen]], words[word[seen]], count[seen])
    trie, replies = Trie(image), []
    number, totals = trie.find(contexts)
    rank, known = trie.words.successor(words)
    codes = trie.follow_ranks(number[context], rank[word], known[word])[at]
    start = first = 0
    for b, hashes, _, own, _ in asked:
        reply = (totals[place[start : start + len(hashes)]], codes[first : first + len(own)])
        replies.append((b, _pack_parts([_packed(reply[0]), reply[1].tobytes(), trie.book.tobytes()])))
        start, first = start + len(hashes), first + len(own)
    return image, int(trie.totals.sum()), contexts[totals > 0], replies


def answered(bundled: DataFrame, frequent: dict[int, int], shards: int) -> DataFrame:
    """The bundles' documents as they came, every shard's trie (bundle -1), and its answers to every bundle."""
    spark = bundled.sparkSession
    shared = spark.sparkContext.broadcast(frequent)
    own = F.when(F.col("shard") < 0, F.col("bundle")).otherwise(0).alias("own")
    dealt = (
        bundled.select("*", own)
        .repartition(max(partitions(spark), 2 * shards), "shard", "own")
        .sortWithinPartitions("shard", "own", "bundle")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["shard", "own"]):
            shard = group.column("shard")[0].as_py()
            if shard < 0:
                n = group.num_rows
                nothing = [pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())]
                columns = [group.column(c).combine_chunks() for c in ("bundle", "shard", "doc_ids", "held_out", "data")]
                yield pa.RecordBatch.from_arrays([*columns, *nothing], names=names)
                continue
            image, tokens, contexts, replies = _answers(group, shared.value)
            often = [h for h in contexts.tolist() if h in shared.value]
            n = len(replies)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([-1, *(b for b, _ in replies)], pa.int64()),
                    pa.array([shard] * (n + 1), pa.int32()),
                    pa.array([np.array(often, np.uint64).view(np.int64), *[None] * n], pa.list_(pa.int64())),
                    pa.nulls(n + 1, pa.list_(pa.bool_())),
                    pa.array([None, *(r for _, r in replies)], pa.binary()),
                    pa.array([image, *[None] * n], pa.binary()),
                    pa.array([tokens, *[None] * n], pa.int64()),
                    pa.array([len(contexts) - len(often), *[None] * n], pa.int64()),
                ],
                names=names,
            )

    names = [part.split()[0] for part in ANSWER.split(", ")]
    return stored(dealt.mapInArrow(work, ANSWER), "trie")


def _score(group: pa.Table, tokens: int, words: int, shards: int) -> dict[str, object]:
    """The documents of one bundle with their scores, from the answers of all shards."""
    rows = group.to_pylist()
    documents = next(r for r in rows if r["shard"] < 0)
    ids, sizes, home, small, end = _parts(documents["data"])
    ids, sizes, home = _unpacked(ids), _unpacked(sizes), _unpacked(home)
    hashed, slices = np.frombuffer(small, np.min_scalar_type(shards - 1)).reshape(2, -1).astype(np.int64)
    slices = slices + 1
    v, w = _bigrams(ids, struct.unpack("<q", end)[0])
    pairs, at = np.unique(v * len(home) + w, return_inverse=True)
    pv, pw = pairs // len(home), pairs % len(home)
    shard, entry, entry_shard = _places(pv, pw, home, hashed, slices, shards)
    by_shard = np.argsort(shard, kind="stable")
    cuts = np.searchsorted(shard[by_shard], np.arange(shards + 1))
    entry_cuts = np.searchsorted(entry_shard, np.arange(shards + 1))
    seen, part, chance = np.zeros(len(home), np.int64), np.zeros(len(pairs)), np.full(len(pairs), -np.inf)
    for r in rows:
        if (s := r["shard"]) >= 0:
            totals, codes, book = _parts(r["data"])
            totals, places = _unpacked(totals), by_shard[cuts[s] : cuts[s + 1]]
            own = entry[entry_cuts[s] : entry_cuts[s + 1]]
            seen[own] += totals
            part[places] = totals[np.searchsorted(own, pv[places])]
            chance[places] = np.r_[np.frombuffer(book, "<f8"), -np.inf][np.frombuffer(codes, np.uint8)]
    # A slice of a frequent word knows its own share of the word's occurrences: brought to all of them.
    after = 10**chance * (part + WEIGHT) / (seen[pv] + WEIGHT)
    single = (seen + 1) / (tokens + words + 1)
    logs = np.log10(after + WEIGHT / (seen[pv] + WEIGHT) * single[pw])[at]
    ends = np.cumsum(sizes)
    starts = ends - sizes
    return {
        "doc_id": pa.array(documents["doc_ids"], pa.int64()),
        "held_out": pa.array(documents["held_out"], pa.bool_()),
        "n_tokens": pa.array(sizes, pa.int64()),
        "n_known": pa.array(np.add.reduceat((seen > 0)[ids].astype(np.int64), starts), pa.int64()),
        "base_score": pa.array(np.add.reduceat(np.log10(single)[ids], starts), pa.float64()),
        "score": pa.array(np.add.reduceat(logs, starts), pa.float64()),
    }


def score(docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """log10 probabilities of every text under a bigram model of the texts that are not held out.

    Columns ``doc_id``, ``held_out``, ``n_tokens`` (words and one end), ``n_known`` (tokens that occur in training),
    ``train_tokens``, ``base_score`` (single words, add-one), ``score``. A word w after v has the probability
    (count(v w) + k p(w)) / (count(v) + k), p the add-one share of single words and k ``WEIGHT``; the
    quotient of the counts is kept with 8 bits. A text's first word follows the end token. Null
    and empty texts are one end token; a null ``held_out`` counts as training.

    The bigrams are counted in bundles, dealt to shards by their first word (those of frequent words
    over several), merged into an Elias-Fano trie for each shard, looked up there for every bundle, and
    added up per document by bundle. Words are told apart by 64-bit hashes, words after the
    same word by 48 bits.
    """
    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.col(text).alias("text"),
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))
    frequent = frequent_words(rows, shards)
    known = answered(bundles(rows, frequent, shards), frequent, shards)
    tries = known.filter("bundle = -1")
    totals = tries.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"), F.coalesce(F.sum("words"), F.lit(0)).alias("words")).first()
    often = tries.select(F.explode("doc_ids")).distinct().count()
    tokens, words = totals.tokens, totals.words + often
    dealt = (
        known.filter("bundle <> -1")
        .select("bundle", "shard", "doc_ids", "held_out", "data")
        .repartition(max(partitions(docs.sparkSession), shards), "bundle")
        .sortWithinPartitions("bundle", "shard")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["bundle"]):
            yield pa.RecordBatch.from_pydict(_score(group, tokens, words, shards))

    schema = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"
    scored = dealt.mapInArrow(work, schema)
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )
