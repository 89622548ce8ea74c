"""Licence scans: expressions against hand-made values, the base columns against SQL, hits against a plain search."""

import random
import re

import pytest

from check import canonical
from lakeloom.llm import licenses
from tests.conftest import SF
from tests.llm.cases import ODD, SCHEMA, frame

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

BASE_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
p AS (SELECT * FROM (VALUES (['gnu', 'general', 'public', 'license'], 'gpl'), (['apache', 'license'], 'apache'), (['cc', 'by'], 'cc-by'), (['mit', 'license'], 'mit')) t(words, label)),
h AS (SELECT doc_id, label, i - 1 AS pos FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d), p WHERE w[i:i + len(words) - 1] = words)
SELECT d.doc_id, len(w)::BIGINT AS n_words, count(pos) AS n_base, min(pos) AS first_word, max(pos) AS last_word,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS base_labels FROM d LEFT JOIN h USING (doc_id) GROUP BY ALL"""


@pytest.mark.parametrize("text, used, labels, chosen, burden", [
    ("MIT", "MIT", "mit", "mit", 0.3),
    ("mit or gpl-3.0", "mit or gpl-3.0", "gpl mit", "mit", 0.3),
    ("MIT AND GPL-3.0-only", "MIT AND GPL-3.0-only", "gpl mit", "gpl mit", 0.8),
    ("MIT OR AGPL-3.0 AND GPL-2.0", "MIT OR AGPL-3.0 AND GPL-2.0", "agpl gpl mit", "mit", 0.3),  # AND binds tighter
    ("(MIT OR AGPL-3.0) AND GPL-2.0", "( MIT OR AGPL-3.0 ) AND GPL-2.0", "agpl gpl mit", "gpl mit", 0.8),
    ("GPL-2.0+ WITH Classpath-exception-2.0 OR AGPL-3.0", "GPL-2.0+ WITH Classpath-exception-2.0 OR AGPL-3.0", "agpl gpl", "gpl", 0.5),
    ("MIT AND", "MIT", "mit", "mit", 0.3),
    ("MIT AND (GPL-2.0 OR", "MIT AND ( GPL-2.0", "gpl mit", "gpl mit", 0.8),
    ("(MIT", "( MIT", "mit", "mit", 0.3),
    ("MIT) OR GPL-2.0", "MIT", "mit", "mit", 0.3),
    ("MIT Apache-2.0", "MIT", "mit", "mit", 0.3),
    ("GPL-2.0 WITH", "GPL-2.0", "gpl", "gpl", 0.8),
    ("Some-Own-Thing", "Some-Own-Thing", "some-own-thing", "some-own-thing", 0.5),
])
def test_expressions(text, used, labels, chosen, burden):
    value, tokens = licenses.evaluate(licenses._TOKEN.findall(text))
    assert (tokens, sorted(value.labels), sorted(value.chosen), value.burden) == (used, labels.split(), chosen.split(), burden)


@pytest.mark.parametrize("text", ["", "AND MIT", ")", "(((", "( AND", "*/"])
def test_no_expression(text):
    assert licenses.evaluate(licenses._TOKEN.findall(text))[0] is None


def test_families():
    assert [licenses.family(n) for n in ("GPL-2.0-or-later", "BSD-3-Clause", "CC-BY-SA-4.0", "0BSD", "CC0-1.0", "LGPL-2.1+", "MIT", "gpl-only")] == [
        "gpl", "bsd", "cc-by-sa", "0bsd", "cc0", "lgpl", "mit", "gpl"]


def test_operators_against_all_ways(spark):
    """Random trees of and/or give the same as a recursive evaluation of the tree."""
    rng = random.Random(3)
    names = ["MIT", "GPL-2.0", "AGPL-3.0", "LGPL-2.1", "CC0-1.0"]

    def grow(depth):
        if not depth or rng.random() < 0.2:
            name = rng.choice(names)
            return name, licenses.Choice.of(licenses.family(name))
        op = rng.choice(["and", "or"])
        (a, x), (b, y) = grow(depth - 1), grow(depth - 1)
        return f"({a} {op} {b})", x.join(op, y)

    for _ in range(300):
        text, value = grow(4)
        got, _ = licenses.evaluate(licenses._TOKEN.findall(text))
        assert got == value, text


def _plain(body: bytes):
    """Every phrase at every place, by comparing word lists."""
    words = WORD.findall(bytes(b + 32 if 65 <= b <= 90 else b for b in body))
    return len(words), sorted((i, len(p.split()), p, label) for p, label in (licenses.BASE | licenses.NOTICES).items()
                              for i in range(len(words)) if words[i:i + len(p.split())] == p.encode().split())


def test_hits_against_plain_search():
    rng, search = random.Random(5), licenses.automaton()
    parts = "gnu general public license lesser apache cc by nc sa mit MIT, bsd 3 clause\n é x".split(" ")
    for _ in range(400):
        body = " ".join(rng.choices(parts, k=rng.randrange(0, 40))).encode()
        n, hits, _ = licenses.scan(search, body)
        assert (n, hits) == _plain(body), body


NOTES = [
    (1, "Licensed under either of the Apache License, Version 2.0 or the MIT license", "apache,mit", 0.3),
    (2, "x\n// SPDX-License-Identifier: GPL-2.0-or-later WITH Classpath-exception-2.0 OR AGPL-3.0\nMIT text", "agpl,gpl", 0.5),
    (3, "MIT License and GNU General Public License", "gpl,mit", 0.8),
    (4, "GNU General Public License version 2 or later with the Classpath exception", "gpl", 0.5),
    (5, "Released under CC BY-NC 4.0.", "cc-by,cc-by-nc", 1.0),
    (6, "the licence of MIT, license unknown", "mit", 0.3),
    (7, "GNU General Public License version 2 or any later version and the MIT license", "gpl,mit", 0.8),
    (8, "é GNU General Public License" * 2, "gpl", 0.8),
    (9, "no permit licenses, cc byline", "", 0.0),
]


def test_notices(spark, monkeypatch):
    docs = frame(spark, [(i, t) for i, t, _, _ in NOTES])
    monkeypatch.setattr(licenses, "table", lambda *_: docs)
    got = {r.doc_id: r for r in licenses.op11_license_scan(spark, "").collect()}
    assert {i: (r.labels, r.score) for i, r in got.items()} == {i: (labels, burden) for i, _, labels, burden in NOTES}
    assert (got[8].n_base, got[8].first_word, got[8].last_word, got[8].n_words) == (1, 5, 5, 9)
    assert (got[9].n_base, got[9].first_word, got[9].base_labels) == (0, None, "")


def test_odd_rows(spark):
    got = sorted((r.doc_id or 0, r.n_words, r.burden, len(r.hits)) for r in licenses.scan_licenses(frame(spark, ODD)).collect())
    assert [g[2:] for g in got] == [(0.0, 0)] * len(ODD)
    assert [g[1] for g in got if g[0] in (1, 2, 3, 4, 8, 9)] == [0, 0, 0, 1, 1, 6000]
    assert [g[1] for g in got if g[0] == 6] == [60, 60] and [g[1] for g in got if g[0] == 0] == [0, 60]
    long = frame(spark, [(1, "w MIT License " * 50_000)])
    row = licenses.scan_licenses(long).selectExpr("n_words", "size(hits) n", "hits[49999].word w").first()
    assert tuple(row) == (150_000, 50_000, 149_998)
    assert licenses.scan_licenses(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_base_columns(spark, duck):
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"]
    got = licenses.op11_license_scan(spark, SF)
    want = duck.execute(BASE_SQL)
    assert canonical(names, got.select(names).collect()) == canonical([d[0] for d in want.description], want.fetchall())
    assert got.filter("score NOT BETWEEN 0 AND 1 OR (labels = '') <> (score = 0)").isEmpty()
    assert not got.filter("n_base > 0").isEmpty()
