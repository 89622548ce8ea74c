"""Sketches kept by day and merged over any range of days.

A day is sketched once, when it is loaded. Medians and distinct counts of a
week, a month or a year come from the kept rows, one per day and key, and the
facts are not read again. Exact answers stay with ``ordered.exact_percentiles``
and ``aggregates.table_scale``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size of a quantile sketch; ranks are off by less than ``RANK_ERROR`` of the rows (three times the stated 99 % error at this size).
QUANTILE_K = 800
RANK_ERROR = 0.0105
#: Binary logarithm of a distinct sketch's registers; counts are off by less than ``COUNT_ERROR`` (four standard errors of a union).
DISTINCT_LOG = 14
COUNT_ERROR = 0.0325


def daily_sketches(df: DataFrame, day: str, keys: list[str], measures: list[str], ids: list[str]) -> DataFrame:
    """One row per day and key: ``n_rows``, ``<measure>_kll`` and ``<id>_hll``.

    Combined on the map side, so a hot day or key sends one sketch per task.
    NULLs are in no sketch; a group without values keeps an empty one.
    """
    return df.groupBy(day, *keys).agg(
        F.count("*").alias("n_rows"),
        *[F.kll_sketch_agg_double(F.col(m).cast("double"), F.lit(QUANTILE_K)).alias(f"{m}_kll") for m in measures],
        *[F.hll_sketch_agg(F.col(i).cast("string"), F.lit(DISTINCT_LOG)).alias(f"{i}_hll") for i in ids])


def _merged(col: str) -> Column:
    if col.endswith("_kll"):
        return F.kll_merge_agg_double(col, F.lit(QUANTILE_K)).alias(col)
    if col.endswith("_hll"):
        return F.hll_union_agg(col).alias(col)
    return F.sum(col).alias(col)


def merge_days(stored: DataFrame, day: str, keys: list[str], first: str | None = None, last: str | None = None) -> DataFrame:
    """One row per key over the days ``first`` to ``last``, both included; None leaves that end open.

    Days are pruned where the store is partitioned by day. Keys may be fewer
    than those stored.
    """
    if first is not None:
        stored = stored.filter(F.col(day) >= F.lit(first).cast("date"))
    if last is not None:
        stored = stored.filter(F.col(day) <= F.lit(last).cast("date"))
    return stored.groupBy(*keys).agg(*[_merged(c) for c in stored.columns if c == "n_rows" or c.endswith(("_kll", "_hll"))])


def rolling_days(stored: DataFrame, day: str, keys: list[str], span: int) -> DataFrame:
    """One row per stored day and key with rows among the ``span`` days that end with it.

    Each kept row goes to the days that look back on it; distinct counts and
    quantiles over moving ranges have no exact form that reads a day once.
    """
    reach = F.explode(F.sequence(F.lit(0), F.lit(span - 1)))
    spread = stored.withColumn("_ahead", reach).withColumn(day, F.date_add(day, F.col("_ahead"))).drop("_ahead")
    seen = stored.select(day).distinct()
    return merge_days(spread.join(seen, day, "left_semi"), day, [day, *keys])


def estimates(merged: DataFrame, quantiles: dict[str, tuple[str, float]], distinct: dict[str, str]) -> DataFrame:
    """Sketches replaced by answers: ``{"median_ms": ("total_duration_ms", 0.5)}`` and ``{"users": "executed_by"}``.

    A quantile of no values is NULL, a distinct count of none 0.
    """
    asked = [F.when(F.kll_sketch_get_n_double(f"{m}_kll") > 0, F.kll_sketch_get_quantile_double(f"{m}_kll", F.lit(p))).alias(name)
             for name, (m, p) in quantiles.items()]
    counted = [F.coalesce(F.hll_sketch_estimate(f"{i}_hll"), F.lit(0)).cast("long").alias(name) for name, i in distinct.items()]
    return merged.select(*[c for c in merged.columns if not c.endswith(("_kll", "_hll"))], *asked, *counted)
