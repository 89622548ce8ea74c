"""Grammar extensions and periodic runs against brute force."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from lakeloom.llm import periods
from lakeloom.llm.common import table
from lakeloom.llm.grammar import Grammar
from tests.conftest import SF
from tests.llm.cases import ODD, SCHEMA, frame


def brute_runs(words, least=24, repeats=3):
    """(start, length, period) of all runs, from the definition."""
    names = {}
    w = np.array([names.setdefault(x, len(names)) for x in words])
    n, found = len(w), {}
    for q in range(1, n // repeats + 1):
        same = np.concatenate([[0], (w[q:] == w[:-q]).astype(int), [0]])
        for a, b in zip(np.flatnonzero(np.diff(same) == 1).tolist(), np.flatnonzero(np.diff(same) == -1).tolist(), strict=True):
            if b - a + q >= max(least, repeats * q):
                found.setdefault((a, b + q), q)  # the smallest period of a stretch comes first
    return sorted((a, b - a, q) for (a, b), q in found.items())


def brute_row(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    runs = sorted(brute_runs(words), key=lambda r: (r[0], r[2]))
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join("%d,%d,%d\n" % r for r in runs).encode()), sha(b" ".join(w for i, w in enumerate(words) if i not in gone)))


@pytest.mark.parametrize("letters", [1, 2, 3, 7])
def test_extensions_of_all_pairs(letters):
    rng = random.Random(letters)
    for _ in range(40):
        parts = [[rng.randrange(letters) for _ in range(rng.randrange(40))] for _ in range(rng.randrange(1, 4))]
        if rng.random() < 0.5:
            parts[0] = (parts[0][:5] or [0]) * 8
        s = [-1] + [x for k, part in enumerate(parts) for x in [*part, -2 - k]]
        pairs = [(i, j) for i in range(1, len(s)) for j in range(i + 1, len(s))]
        if not pairs:
            continue
        i, j = np.array(pairs).T
        g = Grammar(np.array(s))

        def plain(a, b, step):
            count = 0
            while 0 <= a < len(s) and b < len(s) and s[a] == s[b]:
                a, b, count = a + step, b + step, count + 1
            return count

        assert g.extend(i, j).tolist() == [plain(a, b, 1) for a, b in pairs]
        assert g.extend(i, j, back=True).tolist() == [plain(a - 1, b - 1, -1) for a, b in pairs]


def test_grammar_is_small_and_spells_the_sequence():
    s = np.array([-1] + [0, 1, 2, 3] * 5000 + [-2])
    g = Grammar(s)
    assert len(g.symbols[-1]) == 3 and sum(map(len, g.symbols[3:])) < 60_000
    now = list(range(len(g.symbols[-1])))
    for start in reversed(g.starts):
        now = [c for x in now for c in range(start[x], start[x + 1])]
    assert s[now].tolist() == s.tolist()


def random_words(rng):
    """Words with repeated stretches inside repeated stretches."""
    out = []
    while len(out) < 30 or rng.random() < 0.7:
        unit = [rng.choice("abcd") for _ in range(rng.randrange(1, 9))]
        if rng.random() < 0.4:
            unit = (unit * rng.randrange(3, 9) + [rng.choice("ab")]) * 1
        out += (unit * rng.randrange(1, 12))[:rng.randrange(1, 120)]
    return [w.encode() for w in out]


def test_runs_against_brute_force():
    rng = random.Random(11)
    texts = [random_words(rng) for _ in range(250)] + [[], [b"a"], [b"a"] * 23, [b"a"] * 24, [b"x", b"y"] * 12, [b"x", b"y"] * 11]
    for least, repeats in ((24, 3), (6, 3), (12, 4)):
        found, kept = periods.text_runs(texts, least, repeats)
        for words, runs, text in zip(texts, found, kept, strict=True):
            want = sorted(brute_runs(words, least, repeats), key=lambda r: (r[0], r[2]))
            assert [tuple(r) for r in runs.tolist()] == want
            gone = {i for s, n, q in want for i in range(s + q, s + n)}
            assert text == b" ".join(w for i, w in enumerate(words) if i not in gone)
    assert sum(map(len, found)) > 100


def test_batches_do_not_matter():
    rng = random.Random(2)
    texts = [random_words(rng) for _ in range(60)]
    together = periods.text_runs(texts, 24, 3)
    for k, words in enumerate(texts):
        alone = periods.text_runs([words], 24, 3)
        assert alone[0][0].tolist() == together[0][k].tolist() and alone[1][0] == together[1][k]


def test_odd_rows(spark):
    more = [(10, "a " * 300_000), (11, "la li\tlu\n" * 30), (11, "la li\tlu\n" * 30), (12, "la\x1cli " * 40), (13, "  x " * 30), (14, "W" * 3000 + " ")]
    got = sorted((r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], bytes(r.collapsed)) for r in periods.find_runs(frame(spark, ODD + more)).collect())
    by_id = {g[0]: g for g in got}
    assert by_id[1][1:] == by_id[2][1:] == by_id[3][1:] == (0, [], b"") and by_id[9][1:3] == (6000, [])
    assert by_id[10][1:] == (300_000, [(0, 300_000, 1)], b"a")
    assert [g[1:] for g in got if g[0] == 11] == [(90, [(0, 90, 3)], b"la li lu")] * 2
    assert by_id[12][1:] == (40, [(0, 40, 1)], b"la\x1cli")  # no ASCII white space
    assert by_id[13][1:3] == (60, [(0, 60, 2)]) and by_id[14][1] == 1
    assert [g[1] for g in got if g[0] == 0] == [0, 60]
    assert periods.find_runs(spark.createDataFrame([], SCHEMA)).count() == 0


def test_planted_odd_rows(spark, monkeypatch):
    rng = random.Random(4)
    planted = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0]
    texts = [None, "", " ", "one", " two  words ", *(" \t".join(rng.choices("a b c d e f g h é 漢".split(), k=rng.randrange(1, 300))) for _ in planted[5:])]
    docs = frame(spark, [*zip(planted, texts, strict=True), (None, "x " * 30)])
    monkeypatch.setattr(periods, "table", lambda *_: docs)
    got = {r.doc_id: tuple(r) for r in periods.op12_periodic_runs(spark, "").collect()}
    assert got.pop(None)[1:5] == (1, 0, 30, 1)
    assert got == {i: brute_row(i, t) for i, t in zip(planted, texts, strict=True)}


def test_query_against_brute_force(spark):
    want = sorted(brute_row(r.doc_id, r.text) for r in table(spark, SF, "documents").select("doc_id", "text").collect())
    got = sorted(tuple(r) for r in periods.op12_periodic_runs(spark, SF).collect())
    assert got == want
    assert sum(r[1] > 0 for r in want) >= 10
