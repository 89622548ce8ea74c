import itertools
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from lakeloom.llm import itq, jaccard
from lakeloom.llm.jaccard import choose_bands, shared_counts

from .cases import ODD, frame


def closure(ids, pairs):
    root = {i: i for i in ids}
    for _ in ids:
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    return root


def brute(rows, n=5):
    def grams(text):
        w = (text or "").lower().split()
        return {tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()

    sets = [(i, grams(t)) for i, t in rows]
    pairs = [(a, b) for (a, x), (b, y) in itertools.combinations(sets, 2) if x & y and 5 * len(x & y) >= 4 * len(x | y)]
    return pairs, closure([i for i, _ in rows], pairs)


def near_copies():
    rng = random.Random(3)
    rows = []
    for g in range(6):
        base = [f"t{rng.randrange(400)}" for _ in range(120)]
        for _ in range(8):
            own = list(base)
            for _ in range(rng.choice([0, 1, 2, 4, 9])):
                own[rng.randrange(len(own))] = f"n{rng.randrange(10**6)}"
            rows.append((100 * g + len(rows), " ".join(own)))
    return rows


def test_jaccard_matches_brute_force(spark):
    rows = near_copies()
    pairs, root = brute(rows)
    got = {r.doc_id: r for r in jaccard.ngram_jaccard_join(frame(spark, rows)).collect()}
    assert len(got) == len(rows) and len(pairs) > 40
    for i, _ in rows:
        assert got[i].n_links == sum(i in p for p in pairs)
        assert got[i].component_id == root[i] and got[i].kept == (root[i] == i)


def test_jaccard_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 3)
    rows = near_copies()[:16]
    pairs, root = brute(rows)
    got = {r.doc_id: r for r in jaccard.ngram_jaccard_join(frame(spark, rows)).collect()}
    assert {i: got[i].n_links for i, _ in rows} == {i: sum(i in p for p in pairs) for i, _ in rows}
    assert {i: got[i].component_id for i, _ in rows} == root


def test_jaccard_odd_rows(spark):
    got = jaccard.ngram_jaccard_join(frame(spark, ODD)).collect()
    assert len(got) == len(ODD)
    links = sorted((r.doc_id, r.n_links, r.component_id) for r in got if r.doc_id is not None)
    assert links == [(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 0, 4), (5, 2, 5), (6, 2, 5), (6, 2, 5), (7, 0, 7), (8, 0, 8), (9, 0, 9)]
    assert all(r.kept and r.n_links == 0 for r in got if r.doc_id is None)
    assert jaccard.ngram_jaccard_join(frame(spark, [])).collect() == []


def test_short_texts_are_one_gram(spark):
    got = {r.doc_id: r.component_id for r in jaccard.ngram_jaccard_join(frame(spark, [(1, "a b"), (2, "A  b"), (3, "a b c")])).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def test_bands_reach_the_recall():
    bands, rows = choose_bands(0.8, 0.9999, 256)
    assert bands * rows <= 256 and 1 - (1 - 0.8**rows) ** bands >= 0.9999
    assert 1 - (1 - 0.8 ** (rows + 1)) ** (256 // (rows + 1)) < 0.9999


def test_shared_counts():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 40))).astype(np.uint64) for _ in range(70)]
    both = shared_counts(sets)
    for i, j in itertools.combinations(range(70), 2):
        assert both[i, j] == len(np.intersect1d(sets[i], sets[j]))


VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()),
                        T.StructField("rep", T.StringType()), T.StructField("size", T.StringType()), T.StructField("dim", T.StringType())])


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, k, "a", "b", "c") for i, v, k in rows], VECTORS)


@pytest.mark.parametrize("bucket_rows", [50_000, 3])
def test_vectors_match_brute_force(spark, monkeypatch, bucket_rows):
    monkeypatch.setattr(itq, "BUCKET_ROWS", bucket_rows)
    monkeypatch.setattr(itq, "BLOCK", 16)
    rng = np.random.default_rng(1)
    rows = []
    for g in range(12):
        base = rng.standard_normal(24)
        for _ in range(8):
            v = base + rng.standard_normal(24) * rng.choice([0, 0.05, 0.13, 0.3])
            rows.append((int(1000 - len(rows)), v.astype(np.float32).tolist(), int(g % 3)))
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v, _ in rows}
    pairs = [(a, b) for (a, _, x), (b, _, y) in itertools.combinations(rows, 2) if x == y and unit[a] @ unit[b] >= 0.98]
    root = closure([i for i, _, _ in rows], pairs)
    got = {r.vec_id: r for r in itq.near_duplicate_vectors(vectors(spark, rows)).collect()}
    assert len(pairs) > 60
    assert {i: got[i].n_links for i in root} == {i: sum(i in p for p in pairs) for i in root}
    assert {i: got[i].component_id for i in root} == root


def test_common_component_loses_no_pair(spark):
    rng = np.random.default_rng(3)
    n, d = 3000, 64
    common = np.zeros(d)
    common[0] = 0.9
    a = rng.standard_normal((n, d))
    a[:, 0] = 0
    a = common + np.sqrt(0.19) * a / np.linalg.norm(a, axis=1, keepdims=True)
    step = rng.standard_normal((n, d))
    step -= (step * a).sum(1, keepdims=True) * a
    step /= np.linalg.norm(step, axis=1, keepdims=True)
    b = 0.9801 * a + np.sqrt(1 - 0.9801 ** 2) * step
    x = np.concatenate([a, b])
    near = x @ x.T >= 0.98
    got = {r.vec_id: r.n_links for r in itq.near_duplicate_vectors(vectors(spark, [(k, v.tolist(), 0) for k, v in enumerate(x)])).collect()}
    x = x.astype(np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = (x @ x.T >= 0.98).sum(1) - 1
    assert near.sum() > n and [got[k] for k in range(2 * n)] == want.tolist()


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, [1.0, 0.0], 1), (4, [1.0, 0.0], None), (5, None, 0), (6, [0.0, 0.0], 0),
            (7, [nan, 1.0], 0), (8, [inf, 1.0], 0), (9, [None, 1.0], 0), (10, [1.0, 0.0, 0.0], 0), (None, [1.0, 0.0], 0), (11, [], 0), (12, [1e-30, 0.0], 0)]
    got = itq.near_duplicate_vectors(vectors(spark, rows)).collect()
    assert len(got) == len(rows)
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got if r.vec_id is not None) == sorted(
        [(1, 3, 1), (2, 3, 1), (2, 3, 1), (12, 3, 1)] + [(i, 0, i) for i in (3, 4, 5, 6, 7, 8, 9, 10, 11)])
    assert itq.near_duplicate_vectors(vectors(spark, [])).collect() == []


def test_tables_reach_the_recall():
    for rows in (10, 5000, 10**6, 10**9):
        bits, tables = itq.choose_tables(rows, 0.98, 0.999)
        agree = (1 - np.arccos(0.98) / np.pi) ** bits
        assert 1 - (1 - agree) ** tables >= 0.999 and 2**bits * 8 >= min(rows, 2**33)

