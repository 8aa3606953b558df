"""Periodic runs against all periods tried one by one."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from conftest import bag

from peneira.llm import periodic_runs, queries


def brute(words: list) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by comparing at every distance."""
    n, found, known = len(words), [], {}
    numbers = np.array([known.setdefault(w, len(known)) for w in words])
    for q in range(1, n // 4 + 1):
        same = np.concatenate([[False], numbers[:-q] == numbers[q:], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        for s, e in zip(edges[::2].tolist(), (edges[1::2] + q).tolist()):
            if e - s < max(6, 4 * q):
                continue
            if not any(np.array_equal(numbers[s : e - d], numbers[s + d : e]) for d in range(1, q)):
                found.append((s, e - s, q))
    return sorted(found)


def words_of(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def collapsed(words: list[str], runs) -> str:
    return " ".join(w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs))


def random_text(dice: random.Random) -> list[str]:
    """Repeats of random parts, also of repeats, among random words."""
    words: list[str] = []
    for _ in range(dice.randint(1, 5)):
        part = [dice.choice("ab" if dice.random() < 0.5 else "abcdefgh") for _ in range(dice.choice([1, 2, 3, 5, 8, 13, 16, 31, 40]))]
        if dice.random() < 0.3:
            part = part * dice.randint(2, 6) + [dice.choice("xyz")]
        whole = part * dice.randint(1, 7)
        words += whole[: len(whole) - dice.randint(0, len(part) - 1)]
    return words


def test_all_runs_of_many_texts_at_once():
    dice = random.Random(1)
    for _ in range(60):
        texts = [random_text(dice) for _ in range(dice.randint(1, 12))] + [[]]
        texts[-2] += texts[0]  # the same words at the border of two texts
        found = list(periodic_runs._of_batch([" ".join(t).encode() for t in texts]))
        for words, (runs, rest) in zip(texts, found, strict=True):
            assert [(s, e - s, q) for s, e, q in runs] == brute(words)
            assert rest.decode() == collapsed(words, brute(words))


@pytest.mark.parametrize("period", [7, 8, 9, 15, 16, 17, 31, 32, 100, 255, 256, 1000])
@pytest.mark.parametrize("turns", [4, 4.5, 9])
def test_one_run_of_each_period(period, turns):
    dice = random.Random(period)
    for letters in ("ab", [f"w{i}" for i in range(500)]):
        part = [dice.choice(letters) for _ in range(period)]
        for less in (0, 1):
            run = (part * 10)[: int(period * turns) - less]
            words = ["<", *(dice.choice(letters) for _ in range(50)), "|", *run, "|", *run[:20], ">"]
            runs = next(periodic_runs._of_batch([" ".join(words).encode()]))[0]
            assert [(s, e - s, q) for s, e, q in runs] == brute(words)
            assert (53 - 1, len(run), period) in [(s, e - s, q) for s, e, q in runs] or less or len(set(part)) < 3


def test_one_word_over_and_over():
    runs, rest = next(periodic_runs._of_batch([b"a " * 300_000]))
    assert runs == [(0, 300_000, 1)] and rest == b"a"
    thue = [bin(i).count("1") % 2 for i in range(1 << 13)]  # holds no word three times in a row
    assert list(periodic_runs._of_batch([" ".join("ab"[b] for b in thue).encode()]))[0][0] == []


def test_documents(spark, documents, clashing, no_documents, rows):
    wanted = []
    for i, text in rows:
        words = words_of(text)
        runs = brute(words) if len(words) < 5000 else []
        wanted.append((i, [tuple(r) for r in runs], collapsed(words, runs)))
    found = [(r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs.find_runs(clashing).collect()]
    assert sorted(found, key=repr) == sorted(wanted, key=repr)
    assert periodic_runs.find_runs(no_documents).count() == 0
    assert periodic_runs.find_runs(documents, keep=["source"]).columns == ["source", "runs", "collapsed"]


def planted(doc_id: int | None, words: list[str]) -> list[str]:
    if doc_id is None or not words:
        return words
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_the_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    wanted = []
    for i, text in rows:
        words = planted(i, words_of(text))
        runs = brute(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        digests = [hashlib.sha256(t.encode()).hexdigest() for t in ("".join(f"{s},{n},{q}\n" for s, n, q in runs), collapsed(words, runs))]
        wanted.append((i, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], *digests))
    found = queries.QUERIES["op12_periodic_runs"](spark, sf_dir)
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {t for _, t in found.dtypes} == {"bigint", "string"}
    assert bag(found) == sorted(wanted, key=repr)
    assert sum(w[1] > 0 for w in wanted) > 30


def test_planted_runs(documents, rows):
    found = bag(queries.with_planted_runs(documents))
    wanted = [(i, " ".join(planted(i, words_of(t))) if t and planted(i, words_of(t)) != words_of(t) else t) for i, t in rows]
    same = lambda rows: sorted(((i, words_of(t), t is None) for i, t in rows), key=repr)
    assert same(found) == same(wanted)
