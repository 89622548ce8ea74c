"""Ordered operators whose cost does not depend on the largest key.

A window partitioned by a key puts all rows of that key into one task. Keys
with more rows than a task should sort are therefore taken out: their rows are
range partitioned on (key, order), so that a hot key spans many chunks. Each
chunk is scanned on its own and receives what it needs from earlier chunks as a
carry. A chunk continues at most one key, so the carry table has fewer rows
than there are chunks and is safe to broadcast. All other keys take the window.

``order`` must make a total order within a key. ``hot_rows`` None says that the
caller knows all groups to be small, which saves the counting pass.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.operators.sizing import HOT_ROWS, attach, hot_keys, same_keys
from lakeloom.session import durable

CHUNK = "_chunk"
Order = list[Column | str]


def _scan(
    df: DataFrame, keys: list[str], order: Order, hot_rows: int | None,
    plain: Callable[[DataFrame], DataFrame], chunked: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """``plain`` over ordinary keys, ``chunked`` over the range-sorted chunks of hot ones."""
    if hot_rows is None:
        return plain(df)
    found, rows = hot_keys(df, keys, hot_rows)
    if rows == 0:
        return plain(df)
    if not keys:
        return chunked(_chunks(df, keys, order, rows, hot_rows))
    marks = F.broadcast(found.select(*[F.col(k).alias(f"_k_{k}") for k in keys]))
    on = same_keys(df, marks, keys)
    hot = _chunks(df.join(marks, on, "left_semi"), keys, order, rows, hot_rows)
    return plain(df.join(marks, on, "left_anti")).unionByName(chunked(hot))


def _chunks(df: DataFrame, keys: list[str], order: Order, rows: int, hot_rows: int) -> DataFrame:
    """Rows in key and order sequence, cut into numbered chunks, written once so the cut is fixed."""
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows // max(hot_rows, 1_000_000))
    ranged = df.repartitionByRange(n, *[F.col(k) for k in keys], *order)
    return durable(ranged.withColumn(CHUNK, F.spark_partition_id()), "chunks")


def _with_carry(rows: DataFrame, carry: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Attach the carry of (key, chunk); the carry has fewer rows than there are chunks."""
    on = [*keys, CHUNK]
    right = carry.select(*[F.col(c).alias(f"_k_{c}") for c in on], *names)
    return rows.join(F.broadcast(right), same_keys(rows, right, on), "left").drop(*[f"_k_{c}" for c in on])


def running_total(
    df: DataFrame, keys: list[str], order: Order, value: Column, out: str, hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Sum of ``value`` from the first row of the key up to the current row."""
    def total(rows: DataFrame, *by: str) -> DataFrame:
        w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return rows.withColumn(out, F.sum("_v").over(w))

    def chunked(rows: DataFrame) -> DataFrame:
        before = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        carry = (rows.groupBy(*keys, CHUNK).agg(F.sum("_v").alias("_t"))
                 .withColumn("_carry", F.sum("_t").over(before)).filter(F.col("_carry").isNotNull()))
        joined = _with_carry(total(rows, CHUNK, *keys), carry, keys, ["_carry"])
        both = F.when(F.col(out).isNull(), F.col("_carry")).otherwise(F.col(out) + F.coalesce("_carry", F.lit(0)))
        return joined.withColumn(out, both).drop("_carry", CHUNK)

    return _scan(df.withColumn("_v", value), keys, order, hot_rows, lambda rows: total(rows, *keys), chunked).drop("_v")


def sequence_number(df: DataFrame, keys: list[str], order: Order, out: str, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """1, 2, 3, ... within each key."""
    return running_total(df, keys, order, F.lit(1).cast("long"), out, hot_rows)


def rolling_mean(
    df: DataFrame, keys: list[str], order: Order, value: str, rows: int, out: str, digits: int = 3,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Mean of the current and up to ``rows`` - 1 preceding rows, NULLs skipped."""
    back = rows - 1

    def plain(part: DataFrame) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-back, Window.currentRow)
        return part.withColumn(out, F.round(F.avg(value).over(w), digits))

    def chunked(part: DataFrame) -> DataFrame:
        here = Window.partitionBy(CHUNK, *keys).orderBy(*order)
        local = (part.withColumn("_rn", F.row_number().over(here))
                 .withColumn("_s", F.sum(value).over(here.rowsBetween(-back, 0)))
                 .withColumn("_c", F.count(value).over(here.rowsBetween(-back, 0))))
        # Last rows of each (key, chunk): at most rows - 1 of them, so the lists stay short.
        sizes = part.groupBy(*keys, CHUNK).agg(F.count("*").alias("_size"))
        tails = (_with_carry(part.select(*keys, CHUNK, value, F.row_number().over(here).alias("_rn")), sizes, keys, ["_size"])
                 .filter(F.col("_rn") > F.col("_size") - back).groupBy(*keys, CHUNK)
                 .agg(F.sort_array(F.collect_list(F.struct("_rn", F.col(value).alias("v")))).alias("_tail")))
        before = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(-back, -1)
        seen = F.flatten(F.collect_list("_tail").over(before))
        carry = tails.withColumn("_prev", F.transform(seen, lambda r: r["v"])).filter(F.size("_prev") > 0)
        joined = _with_carry(local, carry, keys, ["_prev"])
        prev = F.coalesce("_prev", F.array().cast("array<double>"))
        need = F.least(F.greatest(F.lit(rows) - F.col("_rn"), F.lit(0)), F.size(prev))
        taken = F.filter(F.slice(F.reverse(prev), F.lit(1), need), lambda x: x.isNotNull())
        total = F.coalesce("_s", F.lit(0.0)) + F.aggregate(taken, F.lit(0.0), lambda a, x: a + x)
        count = F.col("_c") + F.size(taken)
        return (joined.withColumn(out, F.round(F.when(count > 0, total / count), digits))
                .drop("_rn", "_s", "_c", "_prev", CHUNK))

    return plain(df) if back == 0 else _scan(df, keys, order, hot_rows, plain, chunked)


def rank_in_group(df: DataFrame, keys: list[str], value: str, out: str, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """``rank()`` by ``value`` descending, NULLs last.

    Ranks depend only on how many rows hold each value, so rows are counted per
    (key, value) before any ordering and the ranks are joined back.
    """
    counts = durable(df.groupBy(*keys, value).agg(F.count("*").alias("_n")), "counts")
    ranked = running_total(counts, keys, [F.col(value).desc_nulls_last()], F.col("_n"), "_upto", hot_rows)
    return attach(df, ranked.select(*keys, value, (F.col("_upto") - F.col("_n") + 1).alias(out)), [*keys, value])


def exact_percentiles(
    df: DataFrame, keys: list[str], value: str, probs: dict[str, float], hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Exact, linearly interpolated percentiles per key.

    The built-in ``percentile`` keeps every distinct value of a group in one
    task. Here values are counted first, positions come from a running count,
    and the two neighbouring values are found by ordinary aggregates.
    """
    if not keys:
        whole = df.select(F.lit(0).alias("_all"), value)
        return exact_percentiles(whole, ["_all"], value, probs, hot_rows).drop("_all")
    counts = durable(df.filter(F.col(value).isNotNull()).groupBy(*keys, value)
                     .agg(F.count("*").alias("_n")), "counts")
    upto = running_total(counts, keys, [value], F.col("_n"), "_upto", hot_rows)
    placed = attach(upto, counts.groupBy(*keys).agg((F.sum("_n") - 1).alias("_last")), keys)
    picks = []
    for name, p in probs.items():
        at = F.col("_last") * F.lit(float(p))
        picks += [
            F.min(F.when(F.col("_upto") > F.floor(at), F.col(value))).alias(f"_lo_{name}"),
            F.min(F.when(F.col("_upto") > F.ceil(at), F.col(value))).alias(f"_hi_{name}"),
            F.max(at - F.floor(at)).alias(f"_w_{name}"),
        ]
    found = placed.groupBy(*keys).agg(*picks)
    return found.select(*keys, *[
        (F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_w_{n}")).alias(n)
        for n in probs])


def nest_rows(
    df: DataFrame, keys: list[str], order: Order, fields: list[str], out: str, max_items: int = 100_000,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Rows as array<struct> per key in order, in parts of at most ``max_items``.

    Ordinary keys give one row with ``part`` 0; a hot key gives several parts,
    so no array and no task holds an unbounded group.
    """
    numbered = sequence_number(df, keys, order, "_seq", hot_rows)
    part = F.floor((F.col("_seq") - 1) / F.lit(max_items)).cast("int")
    item = F.struct("_seq", F.struct(*fields).alias("item"))
    nested = (numbered.withColumn("part", part).groupBy(*keys, "part")
              .agg(F.sort_array(F.collect_list(item)).alias("_items")))
    return nested.withColumn(out, F.col("_items")["item"]).drop("_items")


def list_values(
    df: DataFrame, keys: list[str], value: str, out: str, max_items: int = 100_000, hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Sorted list of all values per key, repeats kept, in parts of ``max_items``.

    Repeats travel as counts: only (key, value, count) is shuffled, and each
    part is unfolded from the runs that fall into it.
    """
    counts = durable(df.filter(F.col(value).isNotNull()).groupBy(*keys, value)
                     .agg(F.count("*").alias("_n")), "counts")
    runs = running_total(counts, keys, [value], F.col("_n"), "_end", hot_rows)
    size = F.lit(max_items)
    spans = (runs.withColumn("_start", F.col("_end") - F.col("_n"))
             .withColumn("part", F.explode(F.sequence(
                 F.floor(F.col("_start") / size).cast("int"),
                 F.floor((F.col("_end") - 1) / size).cast("int")))))
    inside = (F.least(F.col("_end"), (F.col("part") + 1) * size)
              - F.greatest(F.col("_start"), F.col("part") * size)).cast("int")
    listed = (spans.withColumn("_take", inside).groupBy(*keys, "part")
              .agg(F.sort_array(F.collect_list(F.struct(value, "_take"))).alias("_runs")))
    unfolded = F.flatten(F.transform("_runs", lambda r: F.array_repeat(r[value], r["_take"])))
    return listed.withColumn(out, unfolded).drop("_runs")
