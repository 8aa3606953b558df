from __future__ import annotations

import math
import mmap
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from peneira.llm import ngram_trie as nt


@pytest.mark.parametrize("kind", ["sparse", "dense", "equal", "large", "none", "one"])
def test_elias_fano(kind):
    dice = np.random.default_rng(1)
    values = {
        "sparse": np.sort(dice.integers(0, 2**40, 5000)).astype(np.uint64),
        "dense": np.sort(dice.integers(0, 3000, 5000)).astype(np.uint64),
        "equal": np.full(700, 9, np.uint64),
        "large": np.unique(dice.integers(0, 2**64, 3000, dtype=np.uint64)),
        "none": np.zeros(0, np.uint64),
        "one": np.array([0], np.uint64),
    }[kind]
    code = nt.EliasFano(nt.EliasFano.image(values))
    assert (code[np.arange(len(values))] == values).all()
    top = int(values[-1]) if len(values) else 5
    asked = np.unique(np.concatenate([values, dice.integers(0, top + 1, 2000, dtype=np.uint64), np.array([0, top], np.uint64)]))
    asked = np.append(asked, np.uint64(min(top + 1000, 2**64 - 1)))
    place, same = code.successor(asked)
    assert same.tolist() == np.isin(asked, values).tolist()
    exact = np.searchsorted(values, asked)
    assert (place[same] == exact[same]).all()
    if kind == "sparse":
        assert len(nt.EliasFano.image(values)) < 5000 * 6


def test_trie_mapped_into_memory(folder):
    dice = np.random.default_rng(2)
    pairs = np.unique(np.stack([dice.integers(0, 300, 9000), dice.integers(0, 2000, 9000)], axis=1), axis=0)
    names = dice.integers(0, 2**63, 2000, dtype=np.uint64)
    contexts, words = names[pairs[:, 0]], names[pairs[:, 1]] >> np.uint64(16)
    counts = dice.integers(1, 50, len(pairs))
    with open(folder + "/trie", "wb") as out:
        out.write(nt.trie_image(contexts, words, counts))
    with open(folder + "/trie", "rb") as image:
        trie = nt.Trie(memoryview(mmap.mmap(image.fileno(), 0, access=mmap.ACCESS_READ)))
        totals = Counter()
        for c, n in zip(contexts.tolist(), counts.tolist(), strict=True):
            totals[c] += n
        number, seen = trie.find(contexts)
        assert seen.tolist() == [totals[c] for c in contexts.tolist()]
        codes = trie.follow(number, words)
        assert (codes < nt.CODES).all()
        exact = np.log10(counts / (seen + nt.WEIGHT))
        assert np.abs(trie.book[codes] - exact).max() < 0.05
        other = dice.permutation(len(pairs))
        there = set(zip(contexts.tolist(), words.tolist(), strict=True))
        found = trie.follow(number, words[other]) < nt.CODES
        assert found.tolist() == [p in there for p in zip(contexts.tolist(), words[other].tolist(), strict=True)]
        assert trie.find(np.array([1, 2**64 - 1], np.uint64))[0].tolist() == [-1, -1]


def tokens(text: str | None) -> list[str]:
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), "\n"]


def brute(rows, held):
    train = [tokens(t) for i, t in rows if not held(i)]
    single = Counter(w for words in train for w in words)
    pairs = Counter(p for words in train for p in zip(["\n", *words], words))
    total, kinds = sum(single.values()), len(single)
    result = []
    for i, t in rows:
        words = tokens(t)
        share = [(single[w] + 1) / (total + kinds + 1) for w in words]
        scores = [
            math.log10((pairs[v, w] + nt.WEIGHT * p) / (single[v] + nt.WEIGHT))
            for v, w, p in zip(["\n", *words], words, share)
        ]
        known = sum(single[w] > 0 for w in words)
        result.append((i, held(i), len(words), known, total, sum(map(math.log10, share)), sum(scores)))
    return result


@pytest.mark.parametrize(("bundle", "shard"), [(1 << 21, 8 << 20), (500, 8 << 20), (3000, 4000)])
def test_scores(documents, clashing, rows, monkeypatch, bundle, shard):
    monkeypatch.setattr(nt, "SHARD_BYTES", shard)
    original = nt.bundles
    monkeypatch.setattr(nt, "bundles", lambda docs, frequent, shards: original(docs, frequent, shards, bundle))
    found = sorted((tuple(r) for r in nt.score(clashing, F.col("doc_id") % 7 == 2).collect()), key=repr)
    wanted = sorted(brute(rows, lambda i: i is not None and i % 7 == 2), key=repr)
    assert len(found) == len(wanted)
    for a, b in zip(found, wanted, strict=True):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5], rel=1e-9)
        assert a[6] == pytest.approx(b[6], abs=0.06 * b[2])  # eight bits a probability


def test_frequent_words_have_slices_in_proportion(spark):
    """Without an upper bound but the shards, so that no shard holds more than its part of a frequent word."""
    text = "often " * 900 + " ".join(f"w{k}" for k in range(100))
    docs = spark.createDataFrame([(k, text) for k in range(4)], "doc_id bigint, text string")
    found = nt.frequent_words(docs, 1000)
    assert found[nt.word_hash(b"often")] == 4096  # 900 of 1,001 tokens: 3,596 quarters of a shard
    home, part = np.zeros(5000, np.int64), np.arange(5000) * 7919 % (1 << 32)
    slices = np.r_[1000, np.ones(4999, np.int64)]
    shard, _, _ = nt._places(np.zeros(5000, np.int64), np.arange(5000), home, part, slices, 1000)
    assert np.bincount(shard, minlength=1000).tolist() == [5] * 1000


def test_probabilities_add_up(spark):
    """Over all words and the unknown one, after a word that has been seen."""
    docs = spark.createDataFrame([(i, "a b a c") for i in range(8)], "doc_id bigint, text string")
    ask = spark.createDataFrame([(100, "a"), (101, "a a"), (102, "a b"), (103, "a c"), (104, "a new")], docs.schema)
    found = {r.doc_id: r.score for r in nt.score(docs.union(ask), F.col("doc_id") >= 100).collect()}
    base = found[100]
    end = nt.score(docs.union(ask), F.col("doc_id") >= 100).filter("doc_id = 100").first()
    assert end.train_tokens == 40 and end.n_tokens == 2
    assert base < 0 and all(s < 0 for s in found.values()) and found[102] > found[104]


def test_no_documents(no_documents, documents):
    assert nt.score(no_documents, F.lit(False)).count() == 0
    untrained = nt.score(documents, F.lit(True)).collect()
    assert {(r.train_tokens, r.n_known) for r in untrained} == {(0, 0)} and len(untrained) == documents.count()
