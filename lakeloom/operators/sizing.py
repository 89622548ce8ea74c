"""Size checks that decide between broadcast and shuffle, plain and chunked windows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.session import durable

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 32 * 1024 * 1024
# Rows of one key that a single task may sort inside a window.
HOT_ROWS = 5_000_000


def fits_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """True when the whole side is proven small; looks at no more than ``rows`` + 1 rows."""
    probe = df.limit(rows + 1).select(F.length(F.to_json(F.struct("*"))).alias("_size"))
    n, total = probe.agg(F.count("*"), F.coalesce(F.sum("_size"), F.lit(0))).first()
    return n <= rows and total <= size


def checked_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint if the side is proven small, otherwise the side unchanged.

    Without the hint Catalyst and adaptive execution choose the join and split
    skewed partitions, so the answer is the same and only the plan differs.
    """
    return F.broadcast(df) if fits_broadcast(df, rows, size) else df


def same_keys(left: DataFrame, right: DataFrame, keys: list[str], prefix: str = "_k_") -> Column:
    """Equality of keys, NULL equal to NULL; the right side carries them with a prefix."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"{prefix}{k}"]) for k in keys])


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int) -> tuple[DataFrame, int]:
    """(keys holding more than ``hot_rows`` rows, rows they hold together).

    One pass over the keys alone, counted on the map side. There are fewer hot
    keys than rows divided by ``hot_rows``, so the result is small.
    """
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > hot_rows)
    hot = durable(counts, "hot")
    return hot, hot.agg(F.sum("_n")).first()[0] or 0


def attach(df: DataFrame, per_key: DataFrame, keys: list[str]) -> DataFrame:
    """Join one row per key back to all rows of the key; NULL keys match.

    The per-key side is written first. A small one is then broadcast from its
    file size, so the rows never move. With a large one both join inputs are
    plain shuffles, the shape adaptive execution can split when a key is hot;
    an aggregate directly below the join would prevent that.
    """
    side = durable(per_key, "perkey").withColumnsRenamed({k: f"_k_{k}" for k in keys})
    return df.join(side, same_keys(df, side, keys)).drop(*[f"_k_{k}" for k in keys])
