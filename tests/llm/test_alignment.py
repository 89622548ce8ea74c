"""Token alignments against whole texts encoded at once and the definitions of groups and links."""

import hashlib
import random
from bisect import bisect_right
from collections import Counter

import pytest

from lakeloom.llm import alignment
from lakeloom.llm.common import table
from tests.conftest import SF
from tests.llm.cases import ODD, SCHEMA, frame


@pytest.fixture(scope="module")
def sides():
    """Both sides, the first with the model of the file itself in place of its ranks."""
    from tokenizers import Tokenizer

    a, b = alignment.ByteLevel(alignment.BYTE_BPE), alignment.PieceLevel(alignment.PIECE_BPE)
    a.model = Tokenizer.from_file(alignment.BYTE_BPE)
    a.model.encode_special_tokens = True
    return a, b


def brute_ids(sides, text):
    """Ids of a whole text by both, nothing where either does not spell it."""
    a, b = sides
    if not text:
        return [], []
    ids_a, ids_b = a.model.encode(" " + text, add_special_tokens=False).ids, b.model.encode(text)
    body = (" " + text).encode()
    if b"".join(a.raw[i] for i in ids_a) != body or b"".join(b.raw[i] for i in ids_b) != body:
        return [], []
    return ids_a, ids_b


def brute_ends(ids, raw):
    out, end = [], 0
    for i in ids:
        end += len(raw[i])
        out.append(end)
    return out


def brute_rows(sides, rows):
    """All columns of the query, from the definitions."""
    a, b = sides
    made, pairs = [], Counter()
    for doc_id, text in rows:
        ids_a, ids_b = brute_ids(sides, text)
        ends_a, ends_b = brute_ends(ids_a, a.raw), brute_ends(ids_b, b.raw)
        common = sorted(set(ends_a) & set(ends_b))
        slices = lambda ids, ends: [ids[bisect_right(ends, low):bisect_right(ends, high)] for low, high in zip([0, *common], common)]
        groups = list(zip(slices(ids_a, ends_a), slices(ids_b, ends_b)))
        by_end = {}
        for y, f in zip(ids_b, ends_b):
            by_end.setdefault(f, []).append(y)
        links = [(x, y) for x, e in zip(ids_a, ends_a) for y in by_end.get(e, ())]
        pairs.update(links)
        told = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        made.append((doc_id, len(ids_a), len(ids_b), len(groups), links, hashlib.sha256(told.encode()).hexdigest() if ids_a else ""))
    high = Counter()
    for (_, y), n in pairs.items():
        high[y] = max(high[y], n)
    return sorted(((i, na, nb, g, len(links), sha, sum(pairs[p] == high[p[1]] for p in links), sum(pairs[p] for p in links))
                   for i, na, nb, g, links, sha in made), key=repr)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
PARTS = [" ", "  ", "\n", "\t", "a", "the", " the", "1", "'s", "!", "é", "漢字", "▁", "\x00", "\x1c", "\x85", " ", "\U0001F600", "<|endoftext|>", "<s>", "</s>",
         "<0x41>", "<unk>", "\r\n", "ﬁ", "​", "é", "=====", "    x", " \n", "\n ", "tokens"]


def test_vocabularies(sides):
    a, b = sides
    assert len(alignment.byte_letters()) == 256 == len(set(alignment.byte_letters().values()))
    assert len(a.raw) == 50_256 and len(b.raw) == 32_000 and b.single
    assert all(a.raw) and [i for i, r in enumerate(b.raw) if not r] == [0, 1, 2]


def test_units_give_the_ids_of_whole_texts(sides):
    rng = random.Random(7)
    aligner = alignment.Aligner(alignment.BYTE_BPE, alignment.PIECE_BPE)
    texts = ["".join(rng.choices(PARTS, k=rng.randrange(1, 15))) for _ in range(4000)]
    spelled = 0
    for text, got in zip(texts, aligner.tell(texts), strict=True):
        a, b = brute_ids(sides, text)
        groups = [g.split("|") for g in got[3][:-1].split(";")] if got[3] else []
        assert ([int(i) for g in groups for i in g[0].split(",")], [int(i) for g in groups for i in g[1].split(",")]) == (a, b), repr(text)
        assert got[:3] == (len(a), len(b), len(groups)) and aligner.encode([" " + text]) == [(a, b)]
        spelled += bool(a)
    assert 1000 < spelled < 4000


def test_forgetting_changes_nothing(sides, monkeypatch):
    texts = ["one two three four", "five six seven one", "two two ten", "with ▁ mark", ""] * 2
    want = alignment.Aligner(alignment.BYTE_BPE, alignment.PIECE_BPE).tell(texts)
    monkeypatch.setattr(alignment, "REMEMBERED", 3)
    monkeypatch.setattr(alignment, "LONGEST", 4)
    aligner = alignment.Aligner(alignment.BYTE_BPE, alignment.PIECE_BPE)
    assert [aligner.tell([t])[0] for t in texts] == want


def test_ranks_give_the_ids_of_the_merges(sides):
    """Whole documents and random bytes, letters and marks, by ranks and by the list of merges."""
    import duckdb

    rng = random.Random(3)
    texts = [r[0] for r in duckdb.sql(f"SELECT text FROM '{SF}/documents.parquet' WHERE text IS NOT NULL").fetchall()]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 1500), rng.randrange(0x3040, 0x9FFF), 32])) for _ in range(60)) for _ in range(1500)]
    texts += ["".join(rng.choices("aeinorst", k=40)) for _ in range(1500)]
    own = alignment.ByteLevel(alignment.BYTE_BPE)
    assert own.encode(texts) == [e.ids for e in sides[0].model.encode_batch(texts, add_special_tokens=False)]


def test_ids_without_bytes():
    size = [0, 1, 2]
    assert alignment.common_ends([1, 0, 2], [2, 1, 0], size, size) == ([3], [3], [3])
    assert alignment.ending([1, 0, 2], 2, size) == [0, 1] and alignment.ending([1, 0, 2], 3, size) == [2]


def test_alignment_rows(spark, sides):
    a, b = sides
    rows = [(1, "The  tokens of\nboth, 漢字 and é!"), (2, None), (3, ""), (4, " "), (5, "with ▁ mark"), (None, "x"), (6, "a b"), (6, "a b"), (7, "<|endoftext|> </s>")]
    got = alignment.align_tokens(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        assert (r.a_ids, r.b_ids) == brute_ids(sides, texts[r.doc_id])
        body = (" " + (texts[r.doc_id] or "")).encode()
        at = from_a = from_b = 0
        for g in r.groups:
            assert b"".join(a.raw[i] for i in r.a_ids[from_a:g.a_to]) == body[at:g.end] == b"".join(b.raw[i] for i in r.b_ids[from_b:g.b_to])
            at, from_a, from_b = g.end, g.a_to, g.b_to
        assert (from_a, from_b) == (len(r.a_ids), len(r.b_ids)) and (not r.a_ids or at == len(body))
    assert [bool(r.a_ids) for r in sorted(got, key=lambda r: r.doc_id or 0)] == [True, True, False, False, True, False, True, True, True]


def test_odd_rows(spark, sides, monkeypatch):
    rows = [*ODD, (10, "hot " * 40_000), (11, "has ▁"), (12, "漢字" * 20_000), (13, " "), (14, "x  ")]
    for limit in (alignment.AT_ONCE, 50):
        monkeypatch.setattr(alignment, "AT_ONCE", limit)
        monkeypatch.setattr(alignment, "BLOCK", 4 * limit)
        got = sorted((tuple(r) for r in alignment.alignment_counts(frame(spark, rows).repartition(3)).select(COLUMNS).collect()), key=repr)
        assert got == brute_rows(sides, rows)
    assert alignment.alignment_counts(spark.createDataFrame([], SCHEMA)).count() == 0
    assert alignment.align_tokens(spark.createDataFrame([], SCHEMA)).count() == 0
    only_empty = alignment.alignment_counts(frame(spark, [(1, None), (2, "")])).select(COLUMNS).collect()
    assert sorted(map(tuple, only_empty)) == [(1, 0, 0, 0, 0, "", 0, 0), (2, 0, 0, 0, 0, "", 0, 0)]


def test_query_against_brute_force(spark, sides):
    docs = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    got = alignment.op13_token_alignment(spark, SF)
    assert sorted((tuple(r) for r in got.select(COLUMNS).collect()), key=repr) == brute_rows(sides, docs)
