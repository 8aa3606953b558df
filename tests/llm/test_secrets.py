from __future__ import annotations

import math
import random
import re

import pytest
from conftest import bag

from peneira.llm import secret_scan as ss

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)


def brute(text: str) -> list[tuple[int, int, str]]:
    spans = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(a, b, kind) for a, _, b, kind in sorted(spans)]


def hex_text(dice, n):
    return "".join(dice.choice("0123456789abcdef") for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    dice = random.Random(8)
    pieces = ["password", "Token", "API_KEY", "apikey", "secret", " ", " = ", ": ", "'", '"', "AKIA", "ABCDEFGH12345678", "é",
              "abcdef", "0123456789abcdef", "word", "=", "ſecret", "toKen", "\n", ".", "AKIAAKIA", "日"]
    return ["".join(dice.choice(pieces) for _ in range(dice.randint(0, 25))) for _ in range(4000)]


def test_base_spans_are_those_of_the_patterns(texts):
    hits = 0
    for text in texts:
        found = [(a, b, ss.KINDS[k]) for a, b, k, _ in ss.base_spans(text, text.encode().lower())[0]]
        assert found == brute(text)
        hits += len(found)
    assert hits > 500


def test_free_runs():
    assert ss.free_runs([(0, 5, 0), (4, 9, 1), (20, 30, 2)], [(6, 12), (10, 18), (15, 25), (40, 60)]) == [(10, 18), (40, 60)]


def test_automaton_learns_a_format():
    dice = random.Random(9)
    keys = ["ghx_" + hex_text(dice, 24) for _ in range(600)]
    states = ss.learn_automaton(keys)
    assert len(states) < 60  # of a prefix tree with thousands
    for moves in states:
        assert abs(sum(2 ** -bits for bits, _ in moves.values()) - 1) < 1e-6
    own = [ss.cost(states, "ghx_" + hex_text(dice, 24)) / 28 for _ in range(50)]
    other = [ss.cost(states, "".join(dice.choice(ss.ALPHABET) for _ in range(28))) / 28 for _ in range(50)]
    assert max(own) + 1 < min(other)
    assert ss.learn_automaton([]) is None


def docs_with_formats(spark, documents):
    """Credentials named in the text teach a format, which is then found where nothing names it."""
    dice = random.Random(10)
    key = lambda: "zk-" + "".join(dice.choice("ABCDEFGHJKMNPQRS23456789") for _ in range(28))
    named = [(1000 + i, f'words token = "{key()}" and more', None, None, None) for i in range(300)]
    long = lambda: "".join(dice.choice(["un", "re", "mark", "able", "ing", "tion", "er", "con", "ly"]) for _ in range(dice.randint(6, 10)))
    plain = [(2000 + i, " ".join(long() for _ in range(8)), None, None, None) for i in range(300)]
    bare = [(3000 + i, f"see {key()} there", None, None, None) for i in range(20)]
    return documents.unionByName(spark.createDataFrame(named + plain + bare, documents.schema))


def test_formats_are_found_where_nothing_names_them(spark, documents, clashing, no_documents):
    docs = docs_with_formats(spark, documents)
    formats = ss.learn_formats(docs)
    found = {r.doc_id: [tuple(s) for s in r.spans] for r in ss.scan(docs, formats).filter("doc_id >= 1000").collect()}
    assert all([s[0] for s in found[i]] == ["assign"] for i in range(1000, 1300))
    assert sum(found[i] == [("format", 4, 35)] for i in range(3000, 3020)) >= 19
    assert sum(bool(found[i]) for i in range(2000, 2300)) == 0
    rows = {r.doc_id: r.spans for r in ss.scan(documents, formats).collect()}
    assert rows[190] == rows[191] == [] and [s.kind for s in rows[195]] == ["assign", "hex", "access"]
    assert bag(ss.scan(clashing, formats)) == bag(ss.scan(documents, formats))
    assert ss.learn_formats(no_documents) == {} and ss.scan(no_documents, {}).count() == 0
    assert ss.scan(documents, {}).count() == documents.count()


def test_redaction(spark, documents):
    docs = docs_with_formats(spark, documents)
    clean = ss.redact(docs, ss.learn_formats(docs))
    assert clean.columns == docs.columns and clean.count() == docs.count()
    after, before = ({r.doc_id: r.text for r in df.collect()} for df in (clean, docs))
    assert after[195] == '[secret]" and [secret]'
    assert after[3000] == "see [secret] there"
    assert all(after[i] == before[i] for i in range(195)) and after[190] is None


def brute_bits(states, word: str) -> float:
    """Minus the logarithm of the product of the chances along the word's only path, end included."""
    chance, at = 1.0, 0
    for c in word:
        chance *= 2.0 ** -states[at][c][0]
        at = states[at][c][1]
    return -math.log2(chance * 2.0 ** -states[at][""][0]) / len(word)


def test_every_span_is_scored_by_the_automata(spark, documents):
    docs = docs_with_formats(spark, documents)
    formats = ss.learn_formats(docs)
    assert {"assign", "access", "hex", ss.ORDINARY} <= set(formats)
    texts = {r.doc_id: r.text for r in docs.collect()}
    spans = 0
    for row in ss.scan(docs, formats).filter("doc_id is not null").collect():
        assert len(row.spans) == len(row.scores)
        for (kind, a, b), (likely, bits) in zip(row.spans, row.scores, strict=True):
            whole = texts[row.doc_id][a:b]
            secret = ASSIGN.match(whole)[2] if kind == "assign" else whole
            own = {k: brute_bits(states, secret) for k, (states, _) in formats.items() if k != ss.ORDINARY}
            assert abs(bits - min(own.values())) < 1e-9 and own[likely] <= min(own.values()) + 1e-9
            spans += 1
    assert spans > 300
    alone = ss.scan(documents, {}).filter("doc_id = 195").first()
    assert len(alone.scores) == 3 and all(s.likely is None and s.bits is None for s in alone.scores)
