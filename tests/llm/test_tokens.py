import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa

from lakeloom.llm import packing, pieces
from lakeloom.llm.common import chunks

from .cases import ODD, frame

TEXTS = ["", "a", "  a  b\n\n c▁d \U0001F600 \x01é", " ", "\n", "x" * 3000, "it's  1 2\r\n  I'll  x", "ab \t\tcd  ", "\n\n\nfoo", " \n x  \n", "漢字かな"]


def test_segmentations_are_lossless_and_repeat(spark):
    docs = frame(spark, ODD + [(100 + k, t) for k, t in enumerate(TEXTS)])
    once = pieces.sample_pieces(docs)
    rows = once.collect()
    assert len(rows) == len(ODD) + len(TEXTS) and all(r.lossless and r.n_ids == len(r.ids) for r in rows)
    again = pieces.sample_pieces(docs.repartition(7)).collect()
    key = lambda r: (str(r.doc_id), r.n_bytes, r.ids)
    assert sorted(map(key, rows)) == sorted(map(key, again))
    back = sorted((str(r.doc_id), r.text) for r in pieces.decode_pieces(once).collect())
    assert back == sorted((str(r.doc_id), r.text or "") for r in docs.collect())
    other = pieces.sample_pieces(docs, seed=1).collect()
    assert sorted(map(key, rows)) != sorted(map(key, other))
    assert pieces.sample_pieces(frame(spark, [])).collect() == []


def test_segmentations_have_the_right_chances():
    vocabulary = pieces.Pieces.load(pieces.MODEL)
    ids = {raw: i for i, raw in enumerate(vocabulary.raw) if vocabulary.usable[i]}

    def all_ways(body, at=0):
        if at == len(body):
            return [((), 0.0)]
        return [((ids[body[at:to]], *rest), w + vocabulary.weight[ids[body[at:to]]])
                for to in range(at + 1, len(body) + 1) if body[at:to] in ids for rest, w in all_ways(body, to)]

    for word in (b"them", b"other"):
        ways = all_ways(b" " + word)
        total = sum(math.exp(w) for _, w in ways)
        n = 60_000
        drawn, count = pieces.encode_texts(vocabulary, np.frombuffer(word * n, np.uint8), np.arange(n + 1) * len(word), np.arange(n), 9)
        at = np.concatenate([[0], np.cumsum(count)])
        got = Counter(tuple(drawn[a:b].tolist()) for a, b in zip(at[:-1], at[1:], strict=True))
        assert set(got) <= {w for w, _ in ways} and len(ways) > 8
        assert sum(abs(got[k] / n - math.exp(w) / total) for k, w in ways) < 0.02


def test_ids_equal_the_plain_encoding():
    units = packing.UnitIds(packing.read_ranks(packing.VOCABULARY))
    for _, offsets, data in chunks(pa.array(TEXTS)):
        ids, count = units.encode(data, offsets)
        at = np.concatenate([[0], np.cumsum(count)])
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == [units.encoding.encode_ordinary(t) for t in TEXTS]


def test_forgetting_keeps_ids(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 20)
    units = packing.UnitIds(packing.read_ranks(packing.VOCABULARY))
    for k in range(5):
        text = " ".join(f"w{j}" for j in range(k * 7, k * 7 + 15))
        data = np.frombuffer(text.encode(), np.uint8)
        assert units.encode(data, np.array([0, len(data)]))[0].tolist() == units.encoding.encode_ordinary(text)


def brute_rooms(sizes, length):
    rooms = []
    for s in sorted(sizes, reverse=True):
        fits = [r for r in rooms if r >= s]
        if fits:
            rooms.remove(min(fits))
        rooms.append((min(fits) if fits else length) - s)
    return sorted(rooms)


def test_best_fit_decreasing():
    rng = random.Random(1)
    for _ in range(300):
        length = rng.randint(1, 70)
        sizes = [rng.randint(1, length) for _ in range(rng.randint(0, 60))]
        packed = packing.pack(sizes, length)
        assert sorted(k for p in packed for k in p) == list(range(len(sizes)))
        assert sorted(length - sum(sizes[k] for k in p) for p in packed) == brute_rooms(sizes, length)


def test_packed_rows_hold_every_document(spark):
    rows = [(i, t) for i, t in ODD if i is not None and i != 6] + [(100 + k, t) for k, t in enumerate(TEXTS)]
    packed = packing.pack_tokens(frame(spark, rows), length=64).collect()
    units = packing.UnitIds(packing.read_ranks(packing.VOCABULARY))
    found = {}
    for r in packed:
        ids, places, cut = np.frombuffer(r.ids, "<u2"), np.frombuffer(r.positions, "<u2"), r.cu_seqlens
        assert len(ids) == len(places) == 64 and cut[0] == 0 and cut[-1] == r.n_tokens <= 64 and (ids[r.n_tokens:] == 50256).all()
        for k, (doc, start) in enumerate(zip(r.doc_ids, r.doc_starts, strict=True)):
            assert places[cut[k]:cut[k + 1]].tolist() == list(range(cut[k + 1] - cut[k]))
            found.setdefault(doc, {})[start] = ids[cut[k]:cut[k + 1]].tolist()
    assert len({(r.shard, r.window, r.sequence) for r in packed}) == len(packed)
    for i, t in rows:
        whole = [x for s in sorted(found[i]) for x in found[i][s]]
        assert whole == [*units.encoding.encode_ordinary(t or ""), 50256]
    twice = packing.pack_tokens(frame(spark, ODD)).collect()
    assert {d for r in twice for d in r.doc_ids} == {i for i, _ in ODD}
    assert sum(d == 6 for r in twice for d, s in zip(r.doc_ids, r.doc_starts, strict=True) if s == 0) == 2
    assert packing.pack_tokens(frame(spark, [])).collect() == []
