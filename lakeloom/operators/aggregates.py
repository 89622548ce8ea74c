"""Aggregate-shaped operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.operators.ordered import exact_percentiles
from lakeloom.operators.sizing import attach
from lakeloom.session import durable


def counts(df: DataFrame, *keys: str, out: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(out))


def fan_in(legs: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Group count and total of each leg, one row per leg, with an agreement flag."""
    rows = [df.agg(F.lit(name).alias("leg"), F.count("*").alias("n_groups"),
                   F.sum(n).cast("long").alias("total")) for name, (df, n) in legs.items()]
    union = reduce(DataFrame.unionByName, rows)
    return union.withColumn("agree", F.min("total").over(Window.partitionBy())
                            == F.max("total").over(Window.partitionBy()))  # one row per leg


def pivot_counts(df: DataFrame, key: str, col: str, values: list[str]) -> DataFrame:
    """Counts with one column per given value, absent ones 0.

    The value list is explicit: stable columns and one pass instead of two.
    """
    wide = df.groupBy(key).pivot(col, values).agg(F.count(F.lit(1)))
    return wide.na.fill(0, subset=values)


def unpivot_counts(wide: DataFrame, key: str, name: str, value: str) -> DataFrame:
    """Columns back to rows."""
    cols = [c for c in wide.columns if c != key]
    return wide.unpivot([key], cols, name, value)


def summary(df: DataFrame, keys: list[str], col: str, digits: int = 4) -> DataFrame:
    """n, mean, sample deviation, min, quartiles and max over the whole table."""
    probs = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    base = df.groupBy(*keys).agg(
        F.count(col).alias("n"), F.round(F.avg(col), digits).alias("mean"),
        F.round(F.stddev_samp(col), digits).alias("sd"),
        F.min(col).alias("min"), F.max(col).alias("max"))
    quarts = exact_percentiles(df, keys, col, probs)
    if not keys:
        one = base.withColumn("_q", quarts.select(F.struct(*probs)).scalar())
        return one.select("*", *[F.round(F.col(f"_q.{p}"), digits).alias(p) for p in probs]).drop("_q")
    return base.join(quarts.select(*keys, *[F.round(p, digits).alias(p) for p in probs]), keys, "left")


def collapse_timeline(
    periods: DataFrame, run: list[str], start: str, end: str, state: str,
) -> DataFrame:
    """Many period rows to one row per run with its closing state."""
    return periods.groupBy(*run).agg(
        F.min(start).alias("start_time"), F.max(end).alias("end_time"),
        F.max(state).alias("raw_state"))


def share(df: DataFrame, value: str, out: str, within: list[str] | None = None, digits: int = 1) -> DataFrame:
    """Percent of the total, or of the group total; ``df`` is already aggregated.

    Totals are combined on the map side and joined back, so no task holds a group.
    """
    df = durable(df, "share")
    percent = lambda total: F.round(F.col(value) * 100.0 / total, digits)
    if not within:
        return df.withColumn(out, percent(df.agg(F.sum(value)).scalar()))
    whole = attach(df, df.groupBy(*within).agg(F.sum(value).alias("_total")), within)
    return whole.withColumn(out, percent(F.col("_total"))).drop("_total")


def having(df: DataFrame, keys: list[str], more_than: int = 1, out: str = "n") -> DataFrame:
    """Keys occurring more than ``more_than`` times."""
    return df.groupBy(*keys).agg(F.count("*").alias(out)).filter(F.col(out) > more_than)


def labelled(rows: dict[str, DataFrame], label: str = "label") -> DataFrame:
    """Union of one-row frames, each with its label."""
    return reduce(DataFrame.unionByName, [df.withColumn(label, F.lit(n)) for n, df in rows.items()])


def table_scale(df: DataFrame, keys: list[str]) -> DataFrame:
    """Row count and distinct count per key column in one pass."""
    return df.agg(F.count("*").alias("total_rows"),
                  *[F.countDistinct(k).alias(f"distinct_{k}") for k in keys])


def stepped_average(
    df: DataFrame, inner: list[str], outer: list[str], value: str, who: str, digits: int = 3,
) -> DataFrame:
    """Average per inner group first, then the average of those per outer group."""
    first = (df.filter(F.col(value).isNotNull()).groupBy(*inner)
             .agg(F.round(F.avg(value), 6).alias("_avg")))
    return first.groupBy(*outer).agg(
        F.countDistinct(who).alias("students"), F.round(F.avg("_avg"), digits).alias("cohort_avg"))


def conditional_counts(df: DataFrame, keys: list[str], **tests: Column) -> DataFrame:
    """Rows per key and how many satisfy each test."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"), *[
        F.sum(F.when(test, 1).otherwise(0)).alias(name) for name, test in tests.items()])
