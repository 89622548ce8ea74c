"""Data-quality gates, quarantine, profiles and drift (Q01-Q09)."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from lakeloom.operators.ordered import running_total
from lakeloom.session import durable


def expect_or_drop(df: DataFrame, name: str, predicate: Column) -> tuple[DataFrame, Observation]:
    """Keep rows where the predicate is true; drops are counted while the rows flow (Q01)."""
    holds = F.coalesce(predicate, F.lit(False))
    metrics = Observation(name)
    seen = df.observe(metrics, F.count("*").alias("seen"), F.count_if(~holds).alias("dropped"))
    return seen.filter(holds), metrics


def quarantine(df: DataFrame, bad: Column) -> tuple[DataFrame, DataFrame]:
    """(valid, rejects), exact complements whatever NULLs the predicate meets (Q02)."""
    is_bad = F.coalesce(bad, F.lit(False))
    return df.filter(~is_bad), df.filter(is_bad)


def gates(df: DataFrame, checks: dict[str, tuple[Column, Column]]) -> DataFrame:
    """(check_name, passed, value) rows from one aggregate pass (Q03-Q05, Q07).

    Each check is (measured aggregate, passing test on the aggregate).
    """
    agg = df.agg(*[c for n, (v, ok) in checks.items()
                   for c in (v.cast("double").alias(f"v_{n}"), ok.alias(f"p_{n}"))])
    rows = F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(f"p_{n}").alias("passed"),
                              F.col(f"v_{n}").alias("value")) for n in checks])
    return agg.select(F.explode(rows).alias("r")).select("r.*")


def coverage(parts: DataFrame, count: str, whole: DataFrame) -> DataFrame:
    """Do the groups add up to all input rows? (Q03, Q06)"""
    rows = whole.agg(F.count("*").alias("n")).scalar()
    return parts.agg(F.sum(count).cast("long").alias("covered")).select(
        "covered", rows.alias("expected"), (F.col("covered") == rows).alias("passed"))


def unsorted_pairs(df: DataFrame, position: str, value: str) -> DataFrame:
    """Neighbours (by position) whose value increases where it should not (Q05)."""
    nxt = df.select((F.col(position) - 1).alias(position), F.col(value).alias("_next"))
    return df.join(nxt, position).filter(F.col("_next") > F.col(value))


def profile(
    df: DataFrame, columns: list[str], bounds: dict[str, tuple[float, float]] | None = None, exact_distinct: bool = True,
) -> DataFrame:
    """Long profile: count, nulls, distinct, mean, deviation, min, max, outliers per column (Q08).

    One wide aggregate over the table, combined on the map side; no cell becomes
    a row. Exact distinct counts take one more pass for each column, which reads
    and shuffles that column's values alone; without ``exact_distinct`` they
    come from a sketch of the same aggregate (2 percent standard error). An
    empty table gives a row of zero counts for each column.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    lo_hi = bounds or {}

    def measures(c: str) -> list[Column]:
        x = F.col(c).cast("double") if isinstance(types[c], NumericType) else F.lit(None).cast("double")
        low, high = lo_hi.get(c, (None, None))
        out = F.lit(False) if low is None else ~F.col(c).between(low, high)
        count = F.lit(None).cast("long") if exact_distinct else F.approx_count_distinct(c, 0.02)
        return [F.count("*").alias("row_count"), F.count(c).alias("present"), count.alias("distinct_count"), F.avg(x).alias("mean"),
                F.stddev_samp(x).alias("stddev"), F.min(x).alias("min_value"), F.max(x).alias("max_value"),
                F.count(F.when(out, 1)).alias("outliers")]

    wide = df.agg(*[F.struct(F.lit(c).alias("column_name"), *measures(c)).alias(f"_{i}") for i, c in enumerate(columns)])
    rows = wide.select(F.inline(F.array(*[f"_{i}" for i in range(len(columns))])))
    distinct = F.col("distinct_count")
    if exact_distinct:
        each = [df.select(F.col(c)).distinct().agg(F.count(c).alias("_distinct")).select(F.lit(c).alias("column_name"), "_distinct") for c in columns]
        rows, distinct = rows.join(reduce(DataFrame.unionAll, each), "column_name"), F.col("_distinct")
    missing = F.col("row_count") - F.col("present")
    return rows.select(
        "column_name", "row_count", F.round(100.0 * missing / F.nullif(F.col("row_count"), F.lit(0)), 4).alias("null_pct"),
        distinct.alias("distinct_count"), F.round("mean", 4).alias("mean"), F.round("stddev", 3).alias("stddev"),
        "min_value", "max_value", "outliers")


def frequent_values(df: DataFrame, columns: list[str], share: float = 0.01) -> DataFrame:
    """Every value that fills at least ``share`` of a column's rows, with its exact count.

    One aggregate sketches the hashes of all columns. A sketch of 7 / share
    hashes is off by at most half the share, so its best 2 / share candidates
    hold all wanted values; a second pass counts the rows of those candidates
    alone, by value, and drops what falls short. Only candidates are broadcast.
    NULL is no value, but its rows count for the share. Values come as text.
    """
    best, kept = math.ceil(2 / share) + 1, max(math.ceil(7 / share), 16)
    hashed = lambda c: F.when(F.col(c).isNotNull(), F.xxhash64(F.col(c)))
    named = df.select(*[hashed(c).alias(f"_{i}") for i, c in enumerate(columns)])
    found = durable(named.agg(F.count("*").alias("_rows"), *[F.expr(f"approx_top_k(_{i}, {best}, {kept})").alias(f"_{i}") for i in range(len(columns))]), "frequent")
    total = found.select("_rows").scalar()
    parts = []
    for i, c in enumerate(columns):
        likely = found.select(F.explode(F.col(f"_{i}.item")).alias("_h"))
        rows = df.select(F.col(c), hashed(c).alias("_h")).join(F.broadcast(likely), "_h", "left_semi")
        parts.append(rows.groupBy(c).agg(F.count("*").alias("n")).filter(F.col("n") >= F.lit(share) * total)
                     .select(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"), "n", F.round(F.col("n") / total, 6).alias("share")))
    return reduce(DataFrame.unionAll, parts)


def categorical_drift(base: DataFrame, other: DataFrame, col: str, limit: float) -> DataFrame:
    """Total-variation distance of two frequency tables (Q09)."""
    def freq(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(col).agg(F.count("*").alias(name))

    both = freq(base, "a").join(freq(other, "b"), col, "full").na.fill(0, subset=["a", "b"])
    na, nb = both.agg(F.sum("a")).scalar(), both.agg(F.sum("b")).scalar()
    distance = F.sum(F.abs(F.col("a") / na - F.col("b") / nb)) / 2
    return both.agg(F.round(distance, 6).alias("distance")).select(
        F.lit(col).alias("column_name"), F.lit("total_variation").alias("metric"),
        "distance", (F.col("distance") > limit).alias("drifted"))


def numeric_drift(base: DataFrame, other: DataFrame, col: str, limit: float) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov distance from exact value counts (Q09)."""
    tagged = base.select(col, F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(
        other.select(col, F.lit(0).alias("a"), F.lit(1).alias("b"))).filter(F.col(col).isNotNull())
    counts = durable(tagged.groupBy(F.lit(0).alias("_all"), col)
                     .agg(F.sum("a").alias("a"), F.sum("b").alias("b")), "counts")
    order = [F.col(col).asc()]
    cum = running_total(counts, ["_all"], order, F.col("a"), "_ca")
    cum = running_total(cum, ["_all"], order, F.col("b"), "_cb")
    na, nb = counts.agg(F.sum("a")).scalar(), counts.agg(F.sum("b")).scalar()
    gap = F.max(F.abs(F.col("_ca") / na - F.col("_cb") / nb))
    return cum.agg(F.round(gap, 6).alias("distance")).select(
        F.lit(col).alias("column_name"), F.lit("ks").alias("metric"),
        "distance", (F.col("distance") > limit).alias("drifted"))
