"""Trend and weekday forecast against least squares and held-out days."""

import numpy as np
from pyspark.sql import functions as F

from lakeloom.operators.cost import weekday_forecast

DAYS, HELD, SERIES = 120, 30, 150


def noisy(spark):
    """Series with a trend, a weekly shape and normal noise."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("d").cast("int"))
    shape = F.when(F.weekday(day) >= 5, -40.0).otherwise(F.weekday(day) * 5.0)
    noise = F.sqrt(-2 * F.log(F.rand(7) + 1e-9)) * F.cos(2 * np.pi * F.rand(8)) * 10
    return (spark.range(SERIES * DAYS).select((F.col("id") % SERIES).alias("s"), F.floor(F.col("id") / SERIES).alias("d"))
            .select("s", day.alias("day"), (100 + F.col("s") + F.col("d") * 0.7 + shape + noise).alias("y"), "d").toPandas())


def test_held_out_days_and_least_squares(spark):
    rows = noisy(spark)
    known = spark.createDataFrame(rows[rows.d < DAYS - HELD][["s", "day", "y"]])
    found = weekday_forecast(known, "s", "day", "y", HELD).toPandas()
    both = found.merge(rows, on=["s", "day"])
    assert len(both) == SERIES * HELD
    held = ((both.y >= both.low) & (both.y <= both.high)).mean()
    assert 0.87 <= held <= 0.93, held
    width = both.assign(w=both.high - both.low, h=both.d - (DAYS - HELD)).groupby("h").w.mean()
    assert (width.diff(7).dropna() > 0.05).all()  # a weekday's band widens from week to week

    one = rows[(rows.s == 3) & (rows.d < DAYS - HELD)]
    design = lambda d: np.column_stack([np.eye(7)[(np.asarray(d) % 7).astype(int)], d])
    x = design(one.d)
    coef, rest, *_ = np.linalg.lstsq(x, one.y, rcond=None)
    new = design(np.arange(DAYS - HELD, DAYS))
    got = found[found.s == 3].sort_values("day")
    assert np.allclose(got.forecast, new @ coef, atol=0.006)
    df = len(one) - 8
    se = np.sqrt(rest[0] / df * (1 + np.einsum("ij,jk,ik->i", new, np.linalg.inv(x.T @ x), new)))
    assert np.allclose((got.high - got.low) / 2 / se, 1.6637, atol=0.003)  # Student's t, 95 %, 82 degrees


def test_short_series_and_gaps(spark):
    rows = spark.createDataFrame(
        [("two", f"2024-01-0{d}", 5.0 * d) for d in (1, 2)] + [("mondays", f"2024-01-{d:02d}", float(d)) for d in (1, 8, 15, 22)]
        + [("null", "2024-01-01", None), ("null", None, 3.0)], "s string, day string, y double")
    found = weekday_forecast(rows.withColumn("day", F.col("day").cast("date")), "s", "day", "y", 7).toPandas()
    assert sorted(found.s.unique()) == ["mondays", "two"] and len(found) == 14
    own = found[found.s == "mondays"].dropna(subset=["forecast"])
    assert [str(d) for d in own.day] == ["2024-01-29"] and own.forecast.tolist() == [29.0] and own.low.tolist() == [29.0]
    assert found[found.s == "two"].low.isna().all()
    assert weekday_forecast(rows.limit(0).withColumn("day", F.col("day").cast("date")), "s", "day", "y").isEmpty()
