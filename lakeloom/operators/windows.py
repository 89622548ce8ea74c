"""Latest-row, ranking and top-k operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.operators import ordered
from lakeloom.operators.sizing import attach
from lakeloom.session import durable


def latest_per_key(df: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """The row with the greatest ``by`` per key.

    A maximum over structs is combined on the map side, so one hot key sends one
    row per task instead of all its rows to one window task. ``by`` must name a
    total order within the key.
    """
    rest = [c for c in df.columns if c not in keys and c not in by]
    best = df.groupBy(*keys).agg(F.max(F.struct(*by, *rest)).alias("_best"))
    return best.select(*keys, "_best.*").select(*df.columns)


def flag_latest(df: DataFrame, keys: list[str], by: list[str], out: str = "is_last") -> DataFrame:
    """Every row, flagged true where it is the greatest by ``by`` in its key."""
    best = df.groupBy(*keys).agg(F.max(F.struct(*by)).alias("_best"))
    return attach(df, best, keys).withColumn(out, F.struct(*by).eqNullSafe(F.col("_best"))).drop("_best")


def rank_aggregate(
    df: DataFrame, groups: list[str], measures: dict[str, Column], within: list[str],
    by: str, out: str, method: str = "rank", ties: list[str] | None = None, many: bool = False,
) -> DataFrame:
    """Aggregate, then rank the groups; the window sees one row per group only.

    Without ``within``, or where ``many`` groups may share one value of it, the
    ordered scan ranks them, which cuts what is too large for a task.
    """
    agg = df.groupBy(*groups).agg(*[c.alias(n) for n, c in measures.items()])
    order = [F.col(by).desc(), *[F.col(t).asc() for t in ties or []]]
    if many or not within:
        agg = durable(agg, "groups")
        return ordered.rank_in_group(agg, within, by, out) if method == "rank" else ordered.sequence_number(agg, within, order, out)
    w = Window.partitionBy(*within).orderBy(*order)
    return agg.withColumn(out, (F.rank() if method == "rank" else F.row_number()).over(w))


def top(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """First n rows of a total order; runs as a per-task top-n, not a full sort."""
    return df.orderBy(*order).limit(n)


def boundary_keys(df: DataFrame, key: str, n: int, last: bool = False) -> DataFrame:
    """The first or last n distinct keys, as a relation to join with."""
    keys = df.select(key).distinct()
    return top(keys, [F.col(key).desc() if last else F.col(key).asc()], n)
