"""The interval join by ordered carry against a plain range join, over many chunks and a hot key."""

import random

import pytest

from lakeloom.operators.joins import interval_join

FACTS, WINDOWS = "n int, k string, t int, tags map<string,int>", "k string, s int, e int, price double, note map<string,string>"


def plain(facts, windows, how):
    out = []
    for n, k, t, _ in facts:
        hit = [w for w in windows if None not in (k, t, w[0], w[1]) and w[0] == k and w[1] <= t and (w[2] is None or t < w[2])]
        out += [(n, *hit[0][1:4])] if hit else [(n, None, None, None)] if how == "left" else []
    return sorted(out, key=repr)


def made(seed, rows, keys):
    """Windows with gaps, empty and missing ones; a third of all facts on one key, many at one time."""
    rng = random.Random(seed)
    windows = []
    for k in keys:
        at = rng.randrange(20)
        for _ in range(rng.randrange(0, 60)):
            end = at + rng.randrange(1, 30)
            windows.append((k, at, end, float(rng.randrange(99)), {"a": "b"}))
            at = end + rng.choice([0, 0, 5])
        windows += [(k, at, None, 7.0, None), (k, 50, 40, 1.0, None), (k, 50, 50, 1.0, None), (k, None, 9, 1.0, None)]
    windows.append((None, 0, None, 3.0, None))
    pick = lambda: "hot" if rng.random() < 0.34 else rng.choice([*keys, "none", None])
    return [(n, pick(), rng.choice([rng.randrange(900), rng.randrange(900), 77, None]), {"x": n}) for n in range(rows)], windows


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("partitions", ["1", "23"])
def test_against_plain_range_join(spark, how, partitions):
    facts, windows = made(5, 3000, ["hot", "a", "b", "c"])
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = interval_join(spark.createDataFrame(facts, FACTS), spark.createDataFrame(windows, WINDOWS), "k", "t", "s", "e", how)
        assert got.columns == ["n", "k", "t", "tags", "s", "e", "price", "note"]
        assert sorted(((r.n, r.s, r.e, r.price) for r in got.collect()), key=repr) == plain(facts, windows, how)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_empty_sides(spark):
    facts, windows = made(6, 50, ["a"])
    none = spark.createDataFrame([], WINDOWS)
    assert interval_join(spark.createDataFrame(facts, FACTS), none, "k", "t", "s", "e").filter("price IS NULL").count() == 50
    assert interval_join(spark.createDataFrame([], FACTS), spark.createDataFrame(windows, WINDOWS), "k", "t", "s", "e").isEmpty()


@pytest.mark.parametrize("windows", [
    [("a", 1, 5, 1.0, None), ("a", 4, 9, 2.0, None)],
    [("a", 1, None, 1.0, None), ("a", 4, 9, 2.0, None)],
    [("a", 1, 2, 1.0, None), ("a", 1, 3, 2.0, None)],
])
def test_overlaps_are_refused(spark, windows):
    with pytest.raises(ValueError, match="overlap"):
        interval_join(spark.createDataFrame([(1, "a", 1, None)], FACTS), spark.createDataFrame(windows, WINDOWS), "k", "t", "s", "e")


def test_windows_are_never_multiplied_or_broadcast(spark):
    facts, windows = made(7, 500, ["hot", "a"])
    plan = interval_join(spark.createDataFrame(facts, FACTS), spark.createDataFrame(windows, WINDOWS), "k", "t", "s", "e")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in text and "NestedLoop" not in text and "Cartesian" not in text
    assert plan.count() == 500
