"""Words that a polynomial modulo a power of two cannot tell apart: a and b by the parity of the place's bits."""

import numpy as np
import pytest

from lakeloom.llm import common, jaccard, lm, packing, pieces, tiling

from .cases import frame, words


def twins(size):
    a, b = "a", "b"
    while len(a) < size:
        a, b = a + b, b + a
    return a, b


SIZES = [1024, 2048]


def test_hash_is_the_polynomial_modulo_both_primes(monkeypatch):
    rng = np.random.default_rng(3)
    data = rng.integers(0, 256, 5000, dtype=np.uint8)
    starts, ends = np.array([0, 17, 17, 40, 4000]), np.array([0, 18, 5000, 4040, 5000])
    want = []
    for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
        one, two = (sum((int(x) + 1) * pow(r.base, k, p) for k, x in enumerate(data[a:b])) % p for p, r in common.RESIDUES)
        want.append(one << 32 | two)
    want = common.mix(np.array(want, np.uint64)).tolist()
    assert common.span_hashes(data, starts, ends).tolist() == want
    monkeypatch.setattr(common, "EXACT", 700)
    assert common.span_hashes(data, starts, ends).tolist() == want


@pytest.mark.parametrize("size", SIZES)
def test_twins_differ(size):
    a, b = twins(size)
    data = np.frombuffer((a + b + a).encode(), np.uint8)
    first, second, third = common.span_hashes(data, np.arange(3) * size, np.arange(1, 4) * size)
    assert first != second and first == third
    units = packing.UnitIds(packing.read_ranks(packing.VOCABULARY))
    ids, count = units.encode(data, np.arange(4) * size)
    cut = np.split(ids, np.cumsum(count)[:-1])
    assert [x.tolist() for x in cut] == [units.encoding.encode_ordinary(t) for t in (a, b, a)]


def test_operators_tell_twins_apart(spark):
    texts = [t for size in SIZES for t in twins(size)]
    docs = frame(spark, [(k, t) for k, t in enumerate(texts)]).coalesce(1)
    assert all(r.n_links == 0 and r.kept for r in jaccard.ngram_jaccard_join(docs).collect())
    encoded = pieces.sample_pieces(docs)
    assert all(r.lossless for r in encoded.collect())
    assert {r.doc_id: r.text for r in pieces.decode_pieces(encoded).collect()} == dict(enumerate(texts))
    known = {r.doc_id: r.n_known for r in lm.language_model_scores(docs, docs["doc_id"] % 2 == 0).collect()}
    assert known == {0: 2, 1: 1, 2: 2, 3: 1}
    a, b = twins(1024)
    items = spark.createDataFrame([(70, f"{a} {words(0, 6)} {a}")], "item_id long, text string")
    leaks = tiling.decontaminate(frame(spark, [(1, f"{b} {words(0, 3)} {b}"), (2, f"{a} {words(0, 6)} {a}")]), items)
    assert [(r.doc_id, r.item_id) for r in leaks.collect()] == [(2, 70)]


def test_short_spans_are_hashed_by_their_bytes():
    rng = np.random.default_rng(5)
    data = rng.integers(0, 3, 4000, dtype=np.uint8)
    starts = rng.integers(0, 3900, 3000)
    ends = starts + rng.integers(0, 60, 3000)
    whole = [data[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
    codes, one, which = common.distinct(common.word_hashes(data, starts, ends))
    assert len(codes) == len(set(whole)) and [whole[k] for k in one[which].tolist()] == whole
    assert (np.sort(codes) == codes).all() and not len(common.distinct(common.word_hashes(data[:0], starts[:0], ends[:0]))[0])


def test_units_are_spelled_together_as_alone():
    units = packing.UnitIds(packing.read_ranks(packing.VOCABULARY))
    rng = np.random.default_rng(7)
    ends = ["a", "b1", "'s", "é", "\u0085", "\u00a0", "\u2003", "\u3000", "漢", "!", "\x1c", "à", "\u1680"]
    words = [lead + "".join(rng.choice(ends, rng.integers(1, 4))) for lead in [" ", "  ", "", "\n"] for _ in range(500)] + [" ", "  "]
    words = [words[k] for k in rng.permutation(len(words))]
    size = np.array([len(w.encode()) for w in words])
    stop = np.cumsum(size)
    ids, many = units._spell(np.frombuffer("".join(words).encode(), np.uint8), stop - size, stop)
    want = [units.encoding.encode_ordinary(w) for w in words]
    assert many.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]
