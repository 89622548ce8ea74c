import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from lakeloom.llm import repeats
from lakeloom.llm.suffixes import common_prefixes, suffix_array

from .cases import ODD, frame


def brute(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[k:k + length] for t in texts for k in range(len(t) - length + 1))
    out = []
    for (i, _), t in zip(rows, texts, strict=True):
        gone = np.zeros(len(t) + 1, bool)
        for k in range(len(t) - length + 1):
            if seen[t[k:k + length]] > 1:
                gone[k:k + length] = True
        gone = gone[:len(t)]
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()) if len(t) else 0
        out.append((i, len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def sample():
    rng = random.Random(5)
    text = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    shared = [text(150) for _ in range(3)]
    rows = [(1, text(300) + shared[0] + text(200)), (2, shared[0]), (3, text(80) + shared[0][20:] + text(30) + shared[1]), (4, shared[1] + "x" + shared[1]),
            (5, text(99)), (6, "ab" * 400), (7, "z" * 500), (8, text(1500)), (9, text(120) + shared[2][:60] + text(50)), (10, shared[2][:60] + text(90))]
    rows += [(20 + k, text(40) + shared[2] + text(70)) for k in range(12)]
    return rows + [(40, rows[7][1]), (41, rows[7][1])]


@pytest.mark.parametrize("segments", [2000, 2])
def test_matches_brute_force(spark, monkeypatch, segments):
    monkeypatch.setattr(repeats, "SHARD_SEGMENTS", segments)
    monkeypatch.setattr(repeats, "SHARD_BYTES", 4000)
    rows = sample() + [(i, t if t is None else t[:3000]) for i, t in ODD]
    got = repeats.remove_repeats(frame(spark, rows), length=60)
    assert sorted([tuple(r) for r in got.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()], key=repr) == brute(rows, 60)


def test_spans_and_kept_agree(spark):
    rows = sample()
    for r in repeats.remove_repeats(frame(spark, rows), length=60).collect():
        body = dict(rows)[r.doc_id].encode()
        kept, at = b"", 0
        for s in r.spans:
            kept, at = kept + body[at:s.start], s.end
        kept += body[at:]
        assert r.kept is None and not r.spans or bytes(r.kept) == kept
        assert r.kept is None or r.kept_text == kept.decode("utf-8", "ignore")


def test_empty_table(spark):
    assert repeats.remove_repeats(frame(spark, [])).collect() == []


def test_marks_cover_slices(monkeypatch):
    rng = np.random.default_rng(2)
    data = rng.integers(97, 100, 3000).astype(np.uint8)
    whole = repeats.window_marks(data, np.array([0, 1700, 3000]), 60)
    monkeypatch.setattr(repeats, "SLICE", 500)
    cut = repeats.window_marks(data, np.array([0, 1700, 3000]), 60)

    def codes(marks):
        return {(r, w): c for r, c, lo, n, _ in zip(*(m.tolist() for m in marks), strict=True) for w in range(lo, lo + n)}

    assert codes(whole) == codes(cut) and len(codes(whole)) == 1700 - 59 + 1300 - 59


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(0)
    for _ in range(60):
        texts = [bytes(rng.integers(97, 99, rng.integers(1, 40)).astype(np.uint8)) for _ in range(rng.integers(1, 6))]
        size = np.array([len(t) for t in texts])
        ends = np.cumsum(size)
        data = np.frombuffer(b"".join(texts), np.uint8)
        left = np.repeat(ends, size) - np.arange(len(data))
        sa, key = suffix_array(data, left)
        suffixes = [(bytes(data[i:i + left[i]]), i) for i in range(len(data))]
        assert [i for _, i in sorted(suffixes)] == sa.tolist()
        before, shared = common_prefixes(sa, key, left, ends - size, size, 20)
        for r in range(1, len(sa)):
            x, y = suffixes[sa[r]][0], suffixes[sa[r - 1]][0]
            n = 0
            while n < min(len(x), len(y), 20) and x[n] == y[n]:
                n += 1
            assert shared[sa[r]] == n and before[sa[r]] == sa[r - 1]
