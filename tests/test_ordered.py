"""Ordered operators against brute force, on the plain and on the chunked path."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lakeloom.operators import ordered, windows


def rows_with_hot_key(n=400, seed=3):
    rnd = random.Random(seed)
    keys = ["hot"] * (n // 3) + [None] * 5 + [f"k{rnd.randrange(12)}" for _ in range(n - n // 3 - 5)]
    rnd.shuffle(keys)
    return [(k, rnd.randrange(8), i, rnd.choice([None, 0.0, 1.0, 2.3, 3.7, 4.0])) for i, k in enumerate(keys)]


@pytest.fixture(scope="module")
def data():
    return rows_with_hot_key()


@pytest.fixture(scope="module")
def frame(spark, data):
    return spark.createDataFrame(data, "key string, term int, id long, x double").repartition(5)


def groups(data):
    out = defaultdict(list)
    for row in sorted(data, key=lambda r: (r[1], r[2])):
        out[row[0]].append(row)
    return out


ORDER = ["term", "id"]
PATHS = [None, 0, 40]


@pytest.mark.parametrize("hot", PATHS)
def test_running_total(frame, data, hot):
    got = {r.id: r.run for r in ordered.running_total(frame, ["key"], ORDER, F.col("x"), "run", hot_rows=hot).collect()}
    for rows in groups(data).values():
        seen, total = False, 0.0
        for _, _, i, x in rows:
            if x is not None:
                seen, total = True, total + x
            assert got[i] == pytest.approx(total) if seen else got[i] is None


@pytest.mark.parametrize("hot", PATHS)
def test_sequence_number(frame, data, hot):
    got = {r.id: r.n for r in ordered.sequence_number(frame, ["key"], ORDER, "n", hot_rows=hot).collect()}
    want = {row[2]: n for rows in groups(data).values() for n, row in enumerate(rows, 1)}
    assert got == want


@pytest.mark.parametrize("hot", PATHS)
def test_sequence_number_over_all_rows(frame, data, hot):
    got = {r.id: r.n for r in ordered.sequence_number(frame, [], ORDER, "n", hot_rows=hot).collect()}
    assert got == {row[2]: n for n, row in enumerate(sorted(data, key=lambda r: (r[1], r[2])), 1)}


@pytest.mark.parametrize("hot", PATHS)
@pytest.mark.parametrize("width", [1, 2, 3, 7])
def test_rolling_mean(frame, data, hot, width):
    got = {r.id: r.m for r in ordered.rolling_mean(frame, ["key"], ORDER, "x", width, "m", 6, hot_rows=hot).collect()}
    for rows in groups(data).values():
        for at, row in enumerate(rows):
            part = [r[3] for r in rows[max(0, at - width + 1):at + 1] if r[3] is not None]
            if part:
                assert got[row[2]] == pytest.approx(sum(part) / len(part), abs=2e-6)
            else:
                assert got[row[2]] is None


@pytest.mark.parametrize("hot", PATHS)
def test_rank_in_group(frame, data, hot):
    got = {r.id: r.rank for r in ordered.rank_in_group(frame, ["key"], "x", "rank", hot_rows=hot).collect()}
    for rows in groups(data).values():
        for row in rows:
            better = sum(1 for r in rows if r[3] is not None and (row[3] is None or r[3] > row[3]))
            assert got[row[2]] == better + 1


@pytest.mark.parametrize("hot", PATHS)
def test_exact_percentiles(frame, data, hot):
    import numpy as np

    probs = {"q1": 0.25, "med": 0.5, "p95": 0.95, "all": 1.0}
    got = {r.key: r for r in ordered.exact_percentiles(frame, ["key"], "x", probs, hot_rows=hot).collect()}
    for key, rows in groups(data).items():
        values = [r[3] for r in rows if r[3] is not None]
        for name, p in probs.items():
            assert got[key][name] == pytest.approx(float(np.quantile(values, p)))


@pytest.mark.parametrize("hot", PATHS)
@pytest.mark.parametrize("size", [3, 1000])
def test_lists_come_whole_in_parts(frame, data, hot, size):
    rows = ordered.list_values(frame, ["key"], "x", "xs", max_items=size, hot_rows=hot).collect()
    parts = defaultdict(list)
    for r in sorted(rows, key=lambda r: r.part):
        assert len(r.xs) <= size
        parts[r.key] += r.xs
    assert dict(parts) == {k: sorted(r[3] for r in g if r[3] is not None) for k, g in groups(data).items()}


@pytest.mark.parametrize("hot", PATHS)
def test_nested_rows_come_whole_in_parts(frame, data, hot):
    rows = ordered.nest_rows(frame, ["key"], ORDER, ["id"], "items", max_items=4, hot_rows=hot).collect()
    parts = defaultdict(list)
    for r in sorted(rows, key=lambda r: r.part):
        assert len(r["items"]) <= 4
        parts[r.key] += [i.id for i in r["items"]]
    assert dict(parts) == {k: [r[2] for r in g] for k, g in groups(data).items()}


def test_latest_and_flag(frame, data):
    latest = {r.key: r.id for r in windows.latest_per_key(frame, ["key"], ["term", "id"]).collect()}
    want = {k: g[-1][2] for k, g in groups(data).items()}
    assert latest == want
    flags = windows.flag_latest(frame, ["key"], ["term", "id"]).filter("is_last").collect()
    assert {r.key: r.id for r in flags} == want


def test_chunks_split_a_hot_key(frame):
    chunks = ordered._chunks(frame, ["key"], ORDER, 400, 0)
    assert chunks.filter("key = 'hot'").select(ordered.CHUNK).distinct().count() > 1
    continued = chunks.groupBy("key").agg(F.countDistinct(ordered.CHUNK).alias("n")).agg(F.sum(F.col("n") - 1)).first()[0]
    assert continued < chunks.select(ordered.CHUNK).distinct().count()
