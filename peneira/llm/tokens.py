"""Token ids of texts by a public tokenizer's file."""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

from peneira.llm.common import in_chunks

# White space as the tokenizers' patterns know it; fixed values.
BLANKS = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
KNOWN_UNITS = 200_000  # of each of the two generations that a worker keeps, at about 170 bytes a unit
JOINED = 2_000  # new units that are encoded at a time
MARK = "\ue000"
BYTE_BLANK = "\u0120"  # as byte-level vocabularies write a blank
GLUE = "\x01"  # before a unit that follows another without a blank
BEFORE = ("\n", GLUE)
# The words of one kind of tokenizer, a fixed value; and, for a class of a pattern, ASCII without letters, digits and apostrophe.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
OTHERS = r"!-&(-/:-@\[-`{-~"
RUN_CHARS = 1 << 22  # characters whose units are told apart together


def keeps_blanks(tokenizer: str) -> bool | None:
    """Whether a tokenizer makes tokens of white space; None if its file is of no known kind.

    A byte-level one cuts a text before each blank that precedes a word and around other white
    space. One whose pattern leaves white space out cuts at white space. Both cut a word from the stop
    after it. Texts for any other tokenizer are encoded whole.
    """
    made = json.loads(tokenizer)
    cut, change = made.get("pre_tokenizer") or {}, made.get("normalizer")
    if cut.get("type") == "ByteLevel" and cut.get("use_regex") and not cut.get("add_prefix_space") and change is None:
        return True
    steps = cut.get("pretokenizers") or [{}]
    if steps[0].get("type") == "Split" and steps[0].get("invert") and steps[0].get("behavior") == "Removed":
        kept = steps[0]["pattern"].get("Regex", "")
        kinds = [step.get("type") for step in (change or {}).get("normalizers", [])]
        if kept.endswith(r"[^\s\p{L}\p{N}]+") and set(kinds) <= {"NFC", "Replace", "Lowercase"}:
            return False
    return None


class _Worker:
    """A tokenizer and the units it has met, for the life of a worker process.

    A unit is what stands between two blanks of a text, after ``_parted`` has put more blanks where they
    change nothing; one that begins a line has the line break before it, if the tokenizer makes tokens of
    white space. It is encoded as it stands after a blank or a line break.
    """

    def __init__(self, source: str, most: int = KNOWN_UNITS):
        from tokenizers import Tokenizer

        made = json.loads(source)
        self.tokenizer = Tokenizer.from_str(source)
        self.names = [token["content"] for token in made.get("added_tokens") or []]
        self.blanks = keeps_blanks(source)
        kinds = [step.get("type") for step in (made.get("normalizer") or {}).get("normalizers", [])]
        pattern = ((made.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0].get("pattern", {}).get("Regex")
        self.parts = self.blanks is False and pattern == WORD_PATTERN
        self.lowers = self.parts and "Lowercase" in kinds
        self.edge = re.compile(f"[{BLANKS}]").match
        self.most = most
        self.nothing = {} if self.blanks else {"": b""}
        self.young: dict[str, bytes] = dict(self.nothing)
        self.old: dict[str, bytes] = {}
        self.between = "\n" if self.blanks else f" {MARK} "
        self.mark = np.array(self._ids(self.between), "<u4")
        self.line = self.mark.tobytes() if self.blanks else b""
        if self.blanks:
            self.names.append(GLUE)  # a text that holds it is encoded whole
        # Tokens that end a word, if the tokenizer marks those, or that begin with a blank.
        vocabulary, suffix = made["model"]["vocab"], made["model"].get("end_of_word_suffix")
        self.edges = np.zeros(1 + max(vocabulary.values(), default=0), bool)
        if self.blanks or suffix:
            self.edges[[k for t, k in vocabulary.items() if (t[:1] == BYTE_BLANK if self.blanks else t.endswith(suffix))]] = True

    def _ids(self, text: str) -> list[int]:
        """The ids of a text that holds no special token's name. Made of parts of texts, it may by chance hold one."""
        self.tokenizer.encode_special_tokens = True
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _whole(self, text: str) -> np.ndarray:
        self.tokenizer.encode_special_tokens = False
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _encoded(self, parts: list[str]) -> list[bytes]:
        """The ids of texts; many are encoded as one, with what has ids that none of them holds between them."""
        result: list[bytes] = []
        for at in range(0, len(parts), JOINED):
            run = parts[at : at + JOINED]
            ids = np.array(self._ids(self.between.join(run)), "<u4")
            hits = np.flatnonzero(ids[: max(len(ids) - len(self.mark) + 1, 0)] == self.mark[0])
            for k in range(1, len(self.mark)):
                hits = hits[ids[hits + k] == self.mark[k]]
            if len(hits) == len(run) - 1:
                starts = [0, *(hits + len(self.mark)).tolist()]
                result += [ids[a:b].tobytes() for a, b in zip(starts, [*hits.tolist(), len(ids)], strict=True)]
            else:
                result += [array("I", self._ids(u)).tobytes() for u in run]
        return result

    def _encoded_words(self, words: list[str]) -> list[bytes]:
        """The ids of units after a blank, many encoded as one: an id shows that it begins one, or ends one of letters alone."""
        result: list[bytes] = []
        for at in range(0, len(words), JOINED):
            run = words[at : at + JOINED]
            text = " ".join(run)
            ids = np.array(self._ids(f" {text}" if self.blanks else text), "<u4")
            cuts = np.flatnonzero(self.edges[np.minimum(ids, len(self.edges) - 1)])
            cuts = np.append(cuts, len(ids)) if self.blanks else np.append(0, cuts + 1)
            if len(cuts) == len(run) + 1 and cuts[0] == 0 and cuts[-1] == len(ids):
                raw, places = ids.tobytes(), (4 * cuts).tolist()
                result += [raw[a:b] for a, b in zip(places, places[1:], strict=False)]
            else:
                result += [array("I", self._ids(f" {u}" if self.blanks else u)).tobytes() for u in run]
        return result

    def _parted(self, texts: pa.Array) -> pa.Array:
        """The texts with one blank between units.

        Tokenizers cut between ASCII letters, digits and other ASCII characters (an apostrophe apart, which may begin a
        word): a unit that follows another without a blank has ``GLUE`` before it, if blanks make a difference.
        A tokenizer that leaves white space out, and whose words are runs of letters, single digits or runs of other
        characters, gives the same ids if blanks stand there, and if ASCII letters are small, if it makes them so itself.
        """
        if self.blanks:
            texts = pc.replace_substring(pc.binary_join_element_wise("\n", texts, ""), "\n", " \n")
            for left, right in (("A-Za-z", f"{OTHERS}0-9"), ("0-9", f"{OTHERS}A-Za-z"), (OTHERS, "A-Za-z0-9")):
                texts = pc.replace_substring_regex(texts, f"([{left}])([{right}])", f"\\1 {GLUE}\\2")
            return texts
        texts = pc.replace_substring_regex(texts, "[\t-\r]", " ")
        if self.lowers:
            texts = pc.ascii_lower(texts)
        if self.parts:
            texts = pc.replace_substring_regex(texts, f"([A-Za-z])([{OTHERS}0-9])", r"\1 \2")
            texts = pc.replace_substring_regex(texts, "([0-9])", r"\1 ")
            texts = pc.replace_substring_regex(texts, f"([{OTHERS}])([A-Za-z0-9])", r"\1 \2")
        return texts

    def _stands_alone(self, unit: str) -> bool:
        """Not so if a unit is empty or has white space at its ends: that belongs with its neighbours'."""
        text = unit[1:] if unit[:1] in BEFORE else unit
        return not self.blanks or bool(text) and not self.edge(text[0]) and not self.edge(text[-1])

    def _learn(self, units: list[str]) -> dict[str, bytes]:
        """The ids of units that stand alone."""
        known = {u: self.old[u] for u in units if u in self.old}
        if not self.blanks:
            words = [u for u in units if u not in known and u.isascii() and u.isalpha()] if self.parts else []
            known |= zip(words, self._encoded_words(words), strict=True)
            rest = [u for u in units if u not in known]
            plain = [u for u in rest if MARK not in u and u.strip()]
            known |= zip(plain, self._encoded(plain), strict=True)
            return known | {u: array("I", self._ids(u)).tobytes() for u in rest if u not in known}
        new = [u for u in units if u not in known]
        inner = [u for u in new if u[0] not in BEFORE]
        known |= zip(inner, self._encoded_words(inner), strict=True)
        bare = [u for u in new if u[0] in BEFORE]
        # The line break before a unit is the one that stands between two of them.
        for u, ids in zip(bare, self._encoded([u[1:] for u in bare]), strict=True):
            known[u] = self.line + ids if u[0] == "\n" else ids
        return known

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text: from its units, or whole if one of them does not stand alone or it names a special token.

        The units of all texts are told apart once, by Spark's columns' own library; each different one is looked up, and
        the ids are put together as arrays.
        """
        whole = np.array([self.blanks is None or any(name in t for name in self.names) for t in texts], bool)
        lists = pc.split_pattern(self._parted(pa.array(["" if w else t for t, w in zip(texts, whole, strict=True)], pa.string())), " ")
        offsets = lists.offsets.to_numpy()
        units = lists.values.dictionary_encode()
        where, names = units.indices.to_numpy(), units.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = list(map(self.young.get, names))
        new = [k for k, x in enumerate(ids) if x is None]
        alone = [k for k in new if self._stands_alone(names[k])]
        fresh = self._learn([names[k] for k in alone])
        for k in alone:
            ids[k] = fresh[names[k]]
        if len(alone) < len(new):
            lost = np.array([x is None for x in ids])
            ids = [b"" if x is None else x for x in ids]
            owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
            # The first unit of a text, empty, stands before the line break that was put there.
            first = np.zeros(len(where), bool)
            first[offsets[:-1][np.diff(offsets) > 0]] = self.blanks is True
            whole |= np.bincount(owner, lost[where] & ~first, len(texts)) > 0
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        blob = np.frombuffer(b"".join(ids), "<u4")
        counts = sizes[where]
        ends = np.concatenate([[0], np.cumsum(counts)])
        start = (np.cumsum(sizes) - sizes)[where] - ends[:-1]
        kind = np.int32 if max(len(blob), ends[-1]) < 2**31 else np.int64
        at = np.repeat(start.astype(kind), counts)
        at += np.arange(len(at), dtype=kind)
        every, cuts = blob[at], ends[offsets].tolist()
        skip = len(self.line) // 4
        for text, alone_not, a, b in zip(texts, whole.tolist(), cuts, cuts[1:], strict=False):
            yield self._whole(text) if alone_not else every[a + skip : b]
        if len(self.young) + len(fresh) > self.most:
            self.young, self.old = dict(self.nothing), self.young
        self.young |= fresh


def encoder(
    spark: SparkSession, tokenizer_file: str, end_id: int, known_units: int = KNOWN_UNITS
) -> Callable[[list[bytes]], Iterator[np.ndarray]]:
    """A function that gives the ids of each text, as ``tokenizers`` encodes it, and ``end_id`` after them.

    The tokenizer's file is read on the driver and broadcast (a few MB, whatever the corpus). As in the
    library's plain call, the name of a special token in a text is that token. Words repeat, and encoding is the
    dear part: each worker keeps the ids of units it has met, at most twice ``known_units`` of them.
    """
    source = Path(tokenizer_file).read_text(encoding="utf-8")
    shared, name = spark.sparkContext.broadcast(source), hashlib.sha256(source.encode()).hexdigest()

    def encode(raw: list[bytes]) -> Iterator[np.ndarray]:
        import tokenizers

        # Later tasks run in the same worker process: what it knows stays with the library's module.
        workers = vars(tokenizers).setdefault("_peneira_workers", {})
        if (name, known_units) not in workers:
            workers[name, known_units] = _Worker(shared.value, known_units)
        for run in in_chunks([len(t) for t in raw], RUN_CHARS):
            for ids in workers[name, known_units].encode([t.decode("utf-8", "replace") for t in raw[run]]):
                yield np.append(ids, np.uint32(end_id))

    return encode
