import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lakeloom.llm import attention, gam, lm, toxicity
from lakeloom.llm.common import NOT_WORD, SPACE, chunks, spans, table
from lakeloom.llm.queries import QUERIES

from .cases import ODD, frame

SF = "/root/testdata/sf0.01"


def auc(rows, label):
    ranked = sorted(rows, key=lambda r: r.score)
    good = [k for k, r in enumerate(ranked) if r[label] == 1]
    bad = len(ranked) - len(good)
    return (sum(good) - len(good) * (len(good) - 1) / 2) / max(1, len(good) * bad)


@pytest.mark.parametrize(("name", "label", "parts", "held", "cut", "least"), [
    ("op4_toxic_neighbours", "toxic", 5, 0, 0.5, 0.75), ("op7_quality_gam", "quality", 4, 2, 0.7, 0.97)])
def test_scores_hold_out(spark, name, label, parts, held, cut, least):
    got = QUERIES[name](spark, SF)
    rows = got.collect()
    assert len(rows) == table(spark, SF, "documents").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % parts == held)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= cut)
    held_out = got.join(table(spark, SF, "labels").select("doc_id", label), "doc_id").filter("held_out").collect()
    assert len(held_out) > 50 and auc(held_out, label) > least
    assert np.mean([r.predicted == r[label] for r in held_out]) > 0.93


def labelled(spark, rows, label):
    return spark.createDataFrame(rows, f"doc_id long, {label} int, text string")


def test_toxicity_odd_rows(spark):
    bad = [(100 + k, f"you are an idiot number n{k} and a moron") for k in range(40)]
    fine = [(200 + k, f"the garden number n{k} is green and calm") for k in range(60)]
    docs = frame(spark, ODD + bad + fine)
    labels = labelled(spark, [(i, 1, "x") for i, _ in bad[:30]] + [(i, 0, "x") for i, _ in fine] + [(None, 1, "x"), (1, None, "x"), (999, 1, "x")], "toxic")
    rows = toxicity.score_toxicity(docs, labels).collect()
    assert len(rows) == len(ODD) + 100
    by = {r.doc_id: r for r in rows}
    assert min(by[i].score for i, _ in bad) > 0.5 > max(by[i].score for i, _ in fine)
    assert by[1].score == by[2].score == by[8].score and not by[1].evidence
    assert by[135].evidence[0].cosine > 0.9 and 100 <= by[135].evidence[0].id < 140
    assert toxicity.score_toxicity(frame(spark, []), labels).collect() == []
    assert {r.score for r in toxicity.score_toxicity(frame(spark, ODD), labels.limit(0)).collect()} == {0.5}


def test_block_index_finds_the_nearest():
    rng = np.random.default_rng(4)
    x = np.abs(rng.standard_normal((700, 40))) * (rng.random((700, 40)) < 0.15)
    x = (x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-9)).astype(np.float32)
    index = toxicity.Examples(x[:500], np.ones(501, int), np.zeros(501, int), np.arange(501), (0, 0), k=7)
    sims, _ = index.nearest(x[500:])
    exact = -np.sort(-(x[500:] @ x[:500].T), axis=1)[:, :7]
    assert np.allclose(sims, exact, atol=1e-5)


def test_quality_odd_rows(spark):
    rng = random.Random(1)
    good = [(100 + k, " ".join(rng.choice(["sea", "tree", "cloud", "stone."]) + str(rng.randrange(99)) for _ in range(40))) for k in range(60)]
    junk = [(300 + k, " ".join(rng.choice(["SEA!!", "$$$", "***", "|"]) for _ in range(40))) for k in range(60)]
    labels = labelled(spark, [(i, 1, "x") for i, _ in good[:40]] + [(i, 0, "x") for i, _ in junk[:40]] + [(None, 1, "x"), (1, None, "x")], "quality")
    docs = frame(spark, ODD + good + junk)
    model = gam.fit_quality(docs, labels)
    by = {r.doc_id: r.score for r in gam.score_quality(docs, model).collect()}
    assert gam.score_quality(docs, model).count() == len(ODD) + 120
    assert min(by[i] for i, _ in good) > 0.7 > 0.3 > max(by[i] for i, _ in junk) and by[1] == by[2]
    kept = gam.keep_scored(docs, model, 0.7)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= {i for i, _ in good} and kept.filter("doc_id >= 300").count() == 0
    assert gam.score_quality(frame(spark, []), model).collect() == []
    none = gam.fit_quality(docs, labels.limit(0))
    assert {r.score for r in gam.score_quality(docs, none).collect()} == {0.5}


def test_features_and_boosting():
    import pyarrow as pa

    texts = ["", "Ab cd, ab 12\nX | y\nX | y", "é" * 10]
    _, offsets, data = next(chunks(pa.array(texts)))
    x = {k: v for k, v in zip(gam.FEATURES, gam.text_features(offsets, data).T, strict=True)}
    assert not gam.text_features(offsets, data)[0].any()
    assert x["words"][1] == math.log1p(10) and x["bars"][1] == 0.2 and x["multibyte"][2] == 1 and x["distinct_words"][1] == 0.7
    assert x["distinct_lines"][1] == 2 / 3 and x["digits"][1] == 2 / len(texts[1])
    rng = np.random.default_rng(0)
    z = rng.random((4000, 4))
    y = ((z[:, 0] > 0.5) ^ (z[:, 1] > 0.5)).astype(float)  # no feature alone tells
    model = gam.fit_additive(z[:3000], y[:3000])
    assert ((model.score(z[3000:]) > 0.5) == y[3000:]).mean() > 0.95 and (0, 1) in model.pairs


def test_word_spans():
    data = np.frombuffer("ab c\n dé_9!x".encode(), np.uint8)
    text = data.tobytes()
    cut = lambda gap, offsets: [text[a:b].decode() for a, b in zip(*spans(data, np.array(offsets), gap), strict=True)]
    assert cut(SPACE, [0, len(data)]) == ["ab", "c", "dé_9!x"] and cut(NOT_WORD, [0, len(data)]) == ["ab", "c", "dé_9", "x"]
    assert cut(SPACE, [0, 1, 1, len(data)]) == ["a", "b", "c", "dé_9!x"]


def expected(rows, train):
    tokens = [[*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), None] for _, t in rows]
    c = Counter(w for x, ok in zip(tokens, train, strict=True) if ok for w in x)
    n, v = sum(c.values()), len(c)
    return [(i, len(x), sum(c[w] > 0 for w in x), n, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in x)) for (i, _), x in zip(rows, tokens, strict=True)]


def test_language_model_base_and_scores(spark):
    rng = random.Random(2)
    rows = ODD + [(100 + k, " ".join(rng.choice("The of And a stone river Green".split()) for _ in range(60))) for k in range(60)]
    got = lm.language_model_scores(frame(spark, rows), train=None).collect()
    want = expected(rows, [True] * len(rows))
    key = lambda r: (str(r[0]), r[1], r[2])
    got = sorted([(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got], key=key)
    assert len(got) == len(want)
    for a, b in zip(got, sorted(want, key=key), strict=True):
        assert a[:4] == b[:4] and abs(a[4] - b[4]) < 1e-6 * abs(b[4]) and -1e6 < a[5] < 0
    empty = lm.language_model_scores(frame(spark, []))
    assert empty.collect() == []


def test_language_model_beats_the_base(spark):
    rows = QUERIES["op10_attention_scores"](spark, SF).collect()
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    train = [zlib.crc32(str(i).encode()) % 5 != 1 for i, _ in docs]
    want = {i: (n, k, t, b) for i, n, k, t, b in expected(docs, train)}
    for r in rows:
        n, k, t, b = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, k, t) and abs(r.base_score - b) < 1e-6 * abs(b)
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(docs) and sum(r.score for r in held) > 0.95 * sum(r.base_score for r in held)


def test_windows_score_each_place_once():
    counts = np.array([0, 1, 31, 32, 33, 56, 57, 200])
    row, first, scored = attention.windows_of(counts)
    for k, n in enumerate(counts):
        places = [p for r, f, s in zip(row, first, scored, strict=True) if r == k for p in range(f + s, min(f + attention.WINDOW, n))]
        assert places == list(range(n))


def test_gradients_and_causality():
    rng = np.random.default_rng(0)
    net = attention.Attention(20, 6)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, y = rng.integers(0, 20, (3, 9)), rng.integers(0, 6, (3, 9))
    valid = rng.random((3, 9)) < 0.7
    _, g = net.gradients(x, y, valid)
    for name in net.p:
        at = tuple(rng.integers(0, s) for s in net.p[name].shape) if name != "embed" else (int(x[0, 0]), 2)
        held = net.p[name][at]
        net.p[name][at] = held + 1e-5
        up, _ = net.gradients(x, y, valid)
        net.p[name][at] = held - 1e-5
        down, _ = net.gradients(x, y, valid)
        net.p[name][at] = held
        assert abs((up - down) / 2e-5 - g[name][at]) < 1e-4
    changed = x.copy()
    changed[:, 6:] = (changed[:, 6:] + 1) % 20
    assert np.allclose(net.forward(x)["z"][:, :6], net.forward(changed)["z"][:, :6])


def test_rounds_average_the_copies(spark):
    rng = random.Random(6)
    texts = [" ".join(rng.choice(["north wind", "calm sea", "old grey stone"]) for _ in range(80)) for _ in range(24)]
    rows = [(k, k, t, True) for k, t in enumerate(texts)]
    table_of = lm.read_ranks(lm.VOCABULARY)
    ranks = spark.sparkContext.broadcast(table_of)
    _, offsets, data = next(chunks(pa.array(texts)))
    sequences = lm._sequences(lm.UnitIds(table_of), data, offsets, 50256)
    uses, words = np.bincount(sequences[0], minlength=50257), np.bincount(sequences[1][sequences[1] >= 0], minlength=50257)
    vocabulary = attention.Vocabulary.of(uses, words, words > 0)
    start = lambda: attention.Attention(vocabulary.n_inputs, len(vocabulary.mass))
    docs = lambda rows, parts: spark.createDataFrame(spark.sparkContext.parallelize(rows, parts), "id long, key long, text string, train boolean")
    gained = lambda net: net.score(vocabulary, *sequences).sum()
    once = lm.refine(docs(rows, 1), ranks, vocabulary, start(), 50256, rounds=1, share=1)
    twice = lm.refine(docs(rows + rows, 2), ranks, vocabulary, start(), 50256, rounds=1, share=1)
    assert gained(once) > gained(start()) + 1
    assert all(np.allclose(once.p[k], twice.p[k], atol=1e-6) for k in once.p)  # equal parts: the average is the copy
    further = lm.refine(docs(rows, 3), ranks, vocabulary, start(), 50256, rounds=3, share=1)
    again = lm.refine(docs(rows, 3), ranks, vocabulary, start(), 50256, rounds=3, share=1)
    assert all((further.p[k] == again.p[k]).all() for k in further.p)
    idle = lm.refine(docs([(*r[:3], False) for r in rows], 2), ranks, vocabulary, start(), 50256)
    assert all((idle.p[k] == v).all() for k, v in start().p.items())


def test_network_learns_from_each_training_text(spark):
    texts = ["north wind calm sea " * 20, "old grey stone " * 30]
    table_of = lm.read_ranks(lm.VOCABULARY)
    ranks = spark.sparkContext.broadcast(table_of)
    _, offsets, data = next(chunks(pa.array(texts)))
    ids, goals, _ = lm._sequences(lm.UnitIds(table_of), data, offsets, 50256)
    uses, words = np.bincount(ids, minlength=50257), np.bincount(goals[goals >= 0], minlength=50257)
    vocabulary = attention.Vocabulary.of(uses, words, words > 0)
    for k, text in enumerate(texts):  # whichever round a text falls to, and be it the only one
        docs = spark.createDataFrame([(k, k, text, True)], "id long, key long, text string, train boolean")
        net = lm.refine(docs, ranks, vocabulary, lm.start_attention(vocabulary), 50256)
        assert any((net.p[n] != v).any() for n, v in lm.start_attention(vocabulary).p.items())


def test_scoring_equals_the_forward_pass():
    rng = np.random.default_rng(8)
    uses = rng.integers(1, 50, 300)
    vocabulary = attention.Vocabulary.of(uses, uses, np.ones(300), own_classes=20, shared=4, own_inputs=100)
    ids = rng.integers(0, 300, 130)
    goals = np.where(rng.random(130) < 0.4, ids, -1)
    counts = np.array([29, 1, 100])
    for scale in (1, 30):  # with 30 sums of exponentials need their maximum taken off
        net = attention.Attention(vocabulary.n_inputs, len(vocabulary.mass))
        for k in ("embed", "q", "out"):
            net.p[k] = net.p[k] * np.float32(scale)
        windows = attention.Windows(vocabulary, net.start, ids, goals, counts)
        before, wanted, classes = windows.cut(slice(None))
        logits = (net.forward(before)["z"].reshape(-1, 16) @ net.p["out"] + net.p["bias"]).astype(np.float64).reshape(*before.shape, -1)
        high = logits.max(2, keepdims=True)
        logp = np.take_along_axis(logits - high - np.log(np.exp(logits - high).sum(2, keepdims=True)), classes[:, :, None], 2)[:, :, 0]
        want = np.bincount(windows.row, np.where(wanted, logp, 0).sum(1), 3)
        assert wanted.sum() == (goals >= 0).sum() and np.allclose(net.score(vocabulary, ids, goals, counts), want, rtol=1e-4, atol=1e-4)


def test_class_gradients_do_not_depend_on_blocks():
    rng = np.random.default_rng(4)
    for scale in (1, 60):  # with 60 sums of exponentials need their maximum taken off
        net = attention.Attention(20, 6)
        net.p = {k: v.astype(np.float64) * scale for k, v in net.p.items()}
        z, classes = rng.standard_normal((300, 16)), rng.integers(0, 6, 300)
        logits = z @ net.p["out"] + net.p["bias"]
        logits -= logits.max(1, keepdims=True)
        prob = np.exp(logits) / np.exp(logits).sum(1, keepdims=True)
        d = (prob - np.eye(6)[classes]) / 300
        for together in (7, 256, 1000):
            got = net.class_gradients(z, classes, together)
            for a, b in zip(got[1:], (d @ net.p["out"].T, z.T @ d, d.sum(0)), strict=True):
                assert np.allclose(a, b)


def test_a_worker_keeps_spelled_words():
    table_of = lm.read_ranks(lm.VOCABULARY)
    sent = lambda ranks: type("Sent", (), {"value": ranks})
    units = lm.held_units(sent(table_of))
    assert lm.held_units(sent(dict(table_of))) is units  # another task's copy of the vocabulary
    assert lm.held_units(sent({bytes([k]): k for k in range(256)})) is not units


def test_texts_in_ids_are_the_texts():
    table_of = lm.read_ranks(lm.VOCABULARY)
    ranks = type("Sent", (), {"value": table_of})
    rng = random.Random(3)
    texts = ["", "One two\tTHREE  ", None, "x" * 3000 + " " + "9!" * 700, "\n", *(" ".join(rng.choice(["Öl", "a", "漢字", "\u00a0b", "c\u3000"]) for _ in range(50)) for _ in range(4))]
    data = pa.array([t or "" for t in texts])
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(range(len(texts))), pa.array([True] * len(texts)), data], ["id", "key", "train", "text"])
    written = pa.Table.from_batches(lm._spell(ranks, 50256)(iter([batch]))).combine_chunks().to_batches()[0]
    _, offsets, flat = next(chunks(data))
    want = lm._sequences(lm.UnitIds(table_of), flat, offsets, 50256)
    for part in (written, written.slice(1), written.slice(3, 2)):
        at = next(k for k in range(len(texts)) if written["id"][k] == part["id"][0])
        (first, *spelled), = lm._spelled(part)
        upto = np.append(0, np.cumsum(want[2]))
        own = slice(upto[at], upto[at + part.num_rows])
        assert first == 0 and all((a == b).all() for a, b in zip(lm._goals(*spelled), (want[0][own], want[1][own], want[2][at:at + part.num_rows]), strict=True))


def test_only_wanted_places_ask():
    rng = np.random.default_rng(2)
    net = attention.Attention(20, 6)
    x, y = rng.integers(0, 20, (5, 32)), rng.integers(0, 6, (5, 32))
    wanted = np.zeros((5, 32), bool)
    wanted[0, [3, 31]] = wanted[2, 7] = wanted[4, [0, 1, 9]] = True
    f, whole = net.attend(x, wanted), net.forward(x)
    assert f["a"].shape == (5, 3, 32)
    assert np.allclose(f["o"], whole["o"].reshape(160, -1)[wanted.ravel()], atol=1e-6)
    none = net.gradients(x, y, np.zeros((5, 32), bool))
    assert none[0] == 0 and not any(v.any() for v in none[1].values())


def test_words_wanted_by_windows():
    rng = np.random.default_rng(9)
    uses = rng.integers(1, 50, 300)
    vocabulary = attention.Vocabulary.of(uses, uses, np.ones(300), own_classes=20, shared=4, own_inputs=100)
    ids = rng.integers(0, 300, 250)
    windows = attention.Windows(vocabulary, vocabulary.n_inputs - 1, ids, np.where(rng.random(250) < 0.4, ids, -1), np.array([1, 40, 9, 200]))
    assert windows.wants().tolist() == windows.cut(slice(None))[1].sum(1).tolist()


def test_numbers_in_few_bytes():
    for most in (0, 255, 256, 65535, 65536, 1 << 33):
        values = np.array([most, 0, 1 if most else 0])
        held = lm._narrow(values)
        assert lm._wide(held, 3).tolist() == values.tolist() and len(held) == 3 * np.min_scalar_type(most).itemsize
    assert lm._wide(lm._narrow(np.zeros(0, np.int64)), 0).tolist() == []
