from __future__ import annotations

import random

import numpy as np
import pytest
from conftest import bag, sentence

from peneira.llm import decontaminate as dc


def edits(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, d in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != d))
    return row[-1]


def best_place(passage: str, text: str) -> int:
    """Edits of the best match of the passage anywhere in the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(passage, 1):
        last, row[0] = row[0], i
        for j, d in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != d))
    return min(row)


def changed(dice: random.Random, text: str, n: int) -> str:
    for _ in range(n):
        i = dice.randrange(len(text))
        kind = dice.randrange(3)
        text = text[:i] + ("" if kind == 0 else dice.choice("abcdefg")) + text[i + (kind != 1) :]
    return text


@pytest.fixture(scope="module")
def items():
    dice = random.Random(11)
    return [(i, sentence(dice, "en", dice.randint(8, 40))) for i in range(12)]


def test_every_match_within_the_budget_is_found(items):
    dice = random.Random(12)
    index = dc.make_index(items)
    for k in range(150):
        i, passage = items[k % len(items)]
        most = dc.budget(len(passage))
        near = changed(dice, passage, dice.randint(0, most))
        text = sentence(dice, "fr", dice.randint(0, 30)) + near + sentence(dice, "fr", dice.randint(0, 30))
        hits = {h[0]: h for h in dc.search([text], index)[0]}
        assert i in hits
        _, start, end, n = hits[i]
        assert n == edits(passage.lower(), text[start:end].lower()) <= most
        for j, other in items:
            if j not in hits:
                assert best_place(other.lower(), text.lower()) > dc.budget(len(other))


def test_random_texts_agree_with_all_alignments(items):
    dice = random.Random(13)
    short = [(k, changed(dice, t[:40], 3)) for k, t in items]
    index = dc.make_index(short)
    for _ in range(60):
        text = "".join(changed(dice, dice.choice(short)[1], dice.randint(0, 9)) for _ in range(3))
        wanted = {i for i, p in short if best_place(p.lower(), text.lower()) <= dc.budget(len(p))}
        assert {h[0] for h in dc.search([text], index)[0]} == wanted


@pytest.mark.parametrize("size", [1, 2, 5, 7, 8, 9, 10, 13, 15, 19, 20, 23, 29, 30, 31, 39])
def test_short_passages(size):
    """Verbatim below ten characters, then with a tenth of edits, each as the alignment of everything says."""
    dice = random.Random(size)
    items = [(k, "".join(dice.choice("abcdefg ") for _ in range(size - 1)) + "x") for k in range(6)]
    index, most = dc.make_index(items), size // 10
    assert dc.budget(size) == most
    for k in range(80):
        near = changed(dice, items[k % 6][1], dice.randint(0, most + 1))
        text = "".join(dice.choice("abcdefg ") for _ in range(dice.randint(0, 40))) + near.upper() + "gfedcba"[: k % 8]
        hits = dc.search([text], index)[0]
        assert {h[0] for h in hits} == {i for i, p in items if best_place(p, text.lower()) <= most}
        for i, start, end, n in hits:
            assert n == edits(items[i][1], text[start:end].lower()) <= most
            assert most or text[start:end].lower() == items[i][1]


def test_every_place_of_a_verbatim_passage():
    index = dc.make_index([(1, "aa"), (2, "Short\tIt"), (3, " \n"), (4, "")])
    assert dc.search(["aaaa short it", "a", "a short it"], index) == [
        [(1, 0, 2, 0), (1, 1, 3, 0), (1, 2, 4, 0), (2, 5, 13, 0)],
        [],
        [(2, 2, 10, 0)],
    ]
    assert dc.make_index([(3, " \n"), (4, "")])["parts"] == []


def test_texts_are_kept_apart(items):
    passage = items[0][1]
    half = len(passage) // 2
    found = dc.search([passage[:half], passage[half:], "", passage, "x"], dc.make_index(items))
    assert [len(f) for f in found] == [0, 0, 0, 1, 0]
    assert found[3] == [(0, 0, len(passage), 0)]


def test_case_and_white_space_do_not_count(items):
    i, passage = items[1]
    text = "é日 " + passage.upper().replace(" ", "\n") + " end"
    assert dc.search([text], dc.make_index(items))[0] == [(i, 3, 3 + len(passage), 0)]


def test_band_alignment_equals_the_full_one():
    dice = random.Random(14)
    for _ in range(200):
        passage = "".join(dice.choice("ab") for _ in range(dice.randint(8, 25)))
        text = "".join(dice.choice("ab") for _ in range(dice.randint(0, 40)))
        most = len(passage) // 4
        p, t = (np.array([ord(c) for c in x], np.int64) for x in (passage, text))
        row = dc._band_edits(p, t, -len(passage), len(passage) + len(text) + 1, most)
        best = best_place(passage, text)
        assert (row is None or row.min() > most) if best > most else row.min() == best


def test_documents(spark, documents, clashing, no_documents, items):
    dice = random.Random(15)
    planted = [(500 + i, sentence(dice, "fr", 20) + " " + t + " " + sentence(dice, "fr", 20), None, None, None) for i, t in items]
    docs = documents.unionByName(spark.createDataFrame(planted, documents.schema))
    table = [*items, (90, None), (91, ""), (92, "sh~rt"), (93, " "), (None, "a passage without an id, as long as others"), *items[:1]]
    benchmark = spark.createDataFrame(table, "item_id bigint, text string")
    found = dc.passages_in(docs, benchmark)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(500 + i, i) for i, _ in items}
    assert found.filter("edits = 0").count() == len(items)
    assert bag(dc.passages_in(docs, benchmark, block_chars=300)) == bag(found)  # several blocks
    short = spark.createDataFrame([(92, "<|ENDOF"), (93, " ")], benchmark.schema)
    assert [(r.doc_id, r.item_id, r.edits) for r in dc.passages_in(docs, short).collect()] == [(196, 92, 0)]
    assert dc.without_passages(docs, short).count() == docs.count() - 1
    kept = dc.without_passages(docs, benchmark)
    assert kept.columns == docs.columns and bag(kept) == bag(documents)
    assert dc.passages_in(clashing, benchmark).count() == 0
    assert dc.passages_in(no_documents, benchmark).count() == dc.passages_in(docs, benchmark.limit(0)).count() == 0
    assert bag(dc.without_passages(documents, benchmark.limit(0))) == bag(documents)
