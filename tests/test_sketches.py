"""Kept sketches against exact answers over ranges of days."""

import pytest
from pyspark.sql import functions as F

from lakeloom.operators import sketches
from lakeloom.sinks.tables import replace_partition


@pytest.fixture(scope="module")
def facts(spark):
    """A third of all rows on one key and day; key 3 has no values; a NULL key."""
    h = F.pmod(F.xxhash64("id"), F.lit(1_000_000))
    hot = F.col("id") % 3 == 0
    key = F.when(hot, 0).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 4)
    return spark.range(200_000).select(
        F.date_add(F.lit("2024-01-01").cast("date"), F.when(hot, 5).otherwise(F.col("id") % 30).cast("int")).alias("day"),
        key.alias("k"), F.when(key != 3, F.pow(h, F.lit(2))).alias("ms"), (h % 40_000).alias("who"))


def near(spark, facts, found, first, last):
    part = facts.filter(F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    rows = found.collect()
    assert {r.k for r in rows} == {r.k for r in part.select("k").distinct().collect()}
    for r in rows:
        own = part.filter(F.col("k").eqNullSafe(F.lit(r.k)))
        n, values, who = own.agg(F.count("*"), F.count("ms"), F.countDistinct("who")).first()
        assert r.n_rows == n and abs(r.who - who) <= who * sketches.COUNT_ERROR
        if values:
            below, upto = own.agg(F.sum((F.col("ms") < r.mid).cast("int")), F.sum((F.col("ms") <= r.mid).cast("int"))).first()
            assert below / values - sketches.RANK_ERROR <= 0.5 <= upto / values + sketches.RANK_ERROR
        else:
            assert r.mid is None


def test_ranges_of_days_from_the_store(spark, facts, tmp_path):
    path = str(tmp_path / "days")
    replace_partition(sketches.daily_sketches(facts, "day", ["k"], ["ms"], ["who"]), path, "day")
    again = sketches.daily_sketches(facts.filter("day = DATE '2024-01-06'"), "day", ["k"], ["ms"], ["who"])
    stored = replace_partition(again, path, "day")  # a day loaded twice counts once
    for first, last in (("2024-01-01", "2024-01-30"), ("2024-01-04", "2024-01-10"), ("2024-01-06", "2024-01-06")):
        found = sketches.estimates(sketches.merge_days(stored, "day", ["k"], first, last), {"mid": ("ms", 0.5)}, {"who": "who"})
        near(spark, facts, found, first, last)


def test_rolling_days_equal_ranges(spark, facts):
    stored = sketches.daily_sketches(facts, "day", ["k"], ["ms"], ["who"])
    rolled = sketches.estimates(sketches.rolling_days(stored, "day", ["k"], 7), {"mid": ("ms", 0.5)}, {"who": "who"})
    near(spark, facts, rolled.filter("day = DATE '2024-01-12'").drop("day"), "2024-01-06", "2024-01-12")
    assert rolled.agg(F.max("day")).first()[0].isoformat() == "2024-01-30"


def test_an_empty_table(spark, facts):
    stored = sketches.daily_sketches(facts.limit(0), "day", ["k"], ["ms"], ["who"])
    assert stored.isEmpty() and sketches.merge_days(stored, "day", ["k"]).isEmpty()
