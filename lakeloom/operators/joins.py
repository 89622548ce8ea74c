"""Join-shaped operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.operators.ordered import CHUNK, running_total
from lakeloom.operators.sizing import HOT_ROWS, attach, checked_broadcast, fits_broadcast
from lakeloom.session import durable


def star(fact: DataFrame, dims: list[tuple[DataFrame, str]]) -> DataFrame:
    """Inner joins of a fact with its dimensions, each on one shared key name."""
    out = fact
    for dim, key in dims:
        out = out.join(dim, key)
    return out


def enrich(df: DataFrame, lookup: DataFrame, key: str, probe: str, flag: str = "match_status") -> DataFrame:
    """Left join with a matched / UNMATCHED flag."""
    joined = df.join(lookup, key, "left")
    return joined.withColumn(flag, F.when(F.col(probe).isNotNull(), "matched").otherwise("UNMATCHED"))


def join_counts(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Row counts of the inner, left and full join, without building any of them.

    Both sides are first counted per key; the products give the sizes exactly,
    and a key repeated on both sides costs one row instead of all its pairs.
    """
    sides = (left.groupBy(key).agg(F.count("*").alias("_l"))
             .join(right.groupBy(key).agg(F.count("*").alias("_r")), key, "full"))
    both = F.coalesce(F.sum(F.col("_l") * F.col("_r")), F.lit(0))
    left_only = F.coalesce(F.sum(F.when(F.col("_r").isNull(), F.col("_l"))), F.lit(0))
    right_only = F.coalesce(F.sum(F.when(F.col("_l").isNull(), F.col("_r"))), F.lit(0))
    sizes = sides.agg(both.alias("inner"), (both + left_only).alias("left"),
                      (both + left_only + right_only).alias("full"))
    return sizes.unpivot([], ["inner", "left", "full"], "join_type", "row_count")


def split_join(left: DataFrame, right: DataFrame, key: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(matched, left only, right only)."""
    return (left.join(right, key), left.join(right, key, "left_anti"), right.join(left, key, "left_anti"))


def reconcile(
    fact: DataFrame, sources: list[tuple[DataFrame, str]], key: str, own: str,
    out: str = "source_system",
) -> DataFrame:
    """Left join each named source in turn and record who contributed.

    A later source only counts where the earlier one matched, as the sources
    form a chain hanging off the first.
    """
    (chain, first), *others = sources
    chain = chain.withColumn("_src0", F.lit(first))
    for i, (df, label) in enumerate(others, start=1):
        chain = chain.join(df.withColumn(f"_src{i}", F.lit(label)), key, "left")
    marks = [f"_src{i}" for i in range(len(sources))]
    joined = fact.join(chain, key, "left")
    return joined.withColumn(out, F.concat_ws("+", *marks, F.lit(own))).drop(*marks)


def union_by_priority(sources: list[DataFrame], key: str) -> DataFrame:
    """Union sources, keep one row per key, earlier sources win."""
    parts = [df.withColumn("_prio", F.lit(i)) for i, df in enumerate(sources)]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part, allowMissingColumns=True)
    rest = [c for c in union.columns if c not in (key, "_prio")]
    best = union.groupBy(key).agg(F.min(F.struct("_prio", *rest)).alias("_best"))
    return best.select(key, *[F.col(f"_best.{c}").alias(c) for c in rest])


def aggregate_and_join_back(df: DataFrame, keys: list[str], **measures) -> DataFrame:
    """Group measures on every row, for aggregates that windows refuse."""
    return attach(df, df.groupBy(*keys).agg(*[c.alias(n) for n, c in measures.items()]), keys)


def overlapping_windows(
    windows: DataFrame, key: str, start: str, end: str, hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Starts of windows that begin while another of the same key is open.

    Starts count +1 and ends -1 in time order, ends first; a start that brings
    the running count above one lies inside another window.
    """
    opens = windows.select(key, F.col(start).alias("at"), F.lit(1).alias("step"))
    closes = windows.filter(F.col(end).isNotNull()).select(key, F.col(end).alias("at"), F.lit(-1).alias("step"))
    moves = opens.unionByName(closes).groupBy(key, "at", "step").agg(F.sum("step").alias("n"))
    count = running_total(moves, [key], ["at", "step"], F.col("n"), "open", hot_rows=hot_rows)
    return count.filter((F.col("step") == 1) & (F.col("open") > 1)).select(key, F.col("at").alias(start), "open")


def temporal_join(
    facts: DataFrame, windows: DataFrame, key: str, ts: str, start: str, end: str, how: str = "left",
    small: bool | None = None,
) -> DataFrame:
    """Match each fact with all windows of its key that cover its time, overlapping ones too: start <= t < end.

    ``interval_join`` is for windows that do not overlap. A proven-small window table is broadcast (``small`` passes on an earlier check). A large one is cut into months, so
    the join is an equality on (key, month) and a key with long history or many
    facts is spread over its months; the range test is then a residual filter.
    """
    covers = (F.col(ts) >= F.col(start)) & (F.col(end).isNull() | (F.col(ts) < F.col(end)))
    # A window that ends before it starts covers nothing, on either path.
    right = windows.withColumnRenamed(key, "_wkey").filter(F.col(end).isNull() | (F.col(start) < F.col(end)))
    if fits_broadcast(right) if small is None else small:
        return facts.join(F.broadcast(right), (F.col(key) == F.col("_wkey")) & covers, how).drop("_wkey")
    horizon = facts.agg(F.max(ts).alias("m")).first()["m"]  # one value
    first, month = F.trunc(F.col(start), "MM"), F.expr("INTERVAL 1 MONTH")
    last = F.trunc(F.coalesce(F.least(F.col(end), F.lit(horizon)), F.lit(horizon)).cast("date"), "MM")
    cut = (right.filter(F.col(start) <= F.lit(horizon))
           .withColumn("_month", F.explode(F.sequence(first, last, month))))
    on = ((F.col(key) == F.col("_wkey"))
          & (F.trunc(F.col(ts), "MM") == F.col("_month")) & covers)
    return facts.join(cut, on, how).drop("_wkey", "_month")


def interval_join(facts: DataFrame, windows: DataFrame, key: str, ts: str, start: str, end: str, how: str = "left") -> DataFrame:
    """Match each fact with the one window of its key that covers its time: start <= t < end.

    Facts and window starts are united and range partitioned by (key, time), so
    a key with a third of all facts, or very many windows, spans many chunks.
    Within a chunk the last window that began is the only one that can cover a
    fact; a chunk that begins inside a key receives the last window of the
    chunks before it. At most one key a chunk continues, so that carry has fewer
    rows than there are chunks and is safe to broadcast. No size decides.

    Columns of the facts, then those of the window but its key. A window that
    ends before it starts, or without key or start, covers nothing; a fact
    without key or time has no window and stays unless ``how`` is "inner".
    Windows of a key must not overlap (an open end is after everything), which
    is checked here: ValueError.
    """
    told = [c for c in windows.columns if c != key]
    usable = windows.filter(F.col(key).isNotNull() & F.col(start).isNotNull() & (F.col(end).isNull() | (F.col(start) < F.col(end))))
    begins = usable.select(F.col(key).alias("_key"), F.col(start).alias("_at"), F.lit(0).alias("_kind"), F.lit(0.0).alias("_salt"), F.struct(*told).alias("_win"))
    moves = facts.select(F.col(key).alias("_key"), F.col(ts).alias("_at"), F.lit(1).alias("_kind"), F.rand(7).alias("_salt"), F.struct(*facts.columns).alias("_fact"))
    order = ["_at", "_kind", "_salt"]  # the salt spreads facts of one key and time
    rows = durable(begins.unionByName(moves, allowMissingColumns=True).repartitionByRange("_key", *order)
                   .withColumn(CHUNK, F.spark_partition_id()), "moves")
    places = rows.groupBy("_key", CHUNK).agg(F.max_by("_win", F.when(F.col("_kind") == 0, F.col("_at"))).alias("_last"))
    before = Window.partitionBy("_key").orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carry = (places.withColumn("_carry", F.last("_last", True).over(before)).filter("_carry IS NOT NULL AND _key IS NOT NULL")
             .select(F.col("_key").alias("_k"), F.col(CHUNK).alias("_c"), "_carry"))

    def latest(part: DataFrame, upto: int) -> DataFrame:
        here = Window.partitionBy(CHUNK, "_key").orderBy(*order).rowsBetween(Window.unboundedPreceding, upto)
        seen = part.withColumn("_own", F.last("_win", True).over(here))
        carried = seen.join(F.broadcast(carry), (F.col("_key") == F.col("_k")) & (F.col(CHUNK) == F.col("_c")), "left")
        return carried.withColumn("_cur", F.coalesce("_own", "_carry"))

    clash = latest(rows.filter("_kind = 0").drop("_fact"), -1).filter(F.col("_cur").isNotNull() & (F.col(f"_cur.{end}").isNull() | (F.col(f"_cur.{end}") > F.col("_at"))))
    if not clash.limit(1).isEmpty():
        raise ValueError(f"windows of one {key} overlap: facts would count twice")
    covered = F.col(f"_cur.{end}").isNull() | (F.col("_at") < F.col(f"_cur.{end}"))
    found = latest(rows, 0).filter("_kind = 1").withColumn("_cur", F.when(F.col("_key").isNotNull() & F.col("_at").isNotNull() & covered, F.col("_cur")))
    if how == "inner":
        found = found.filter("_cur IS NOT NULL")
    return found.select("_fact.*", *[F.col(f"_cur.{c}").alias(c) for c in told])


def blend(governed: DataFrame, upload: DataFrame, key: str, probe: str) -> tuple[DataFrame, DataFrame]:
    """Governed rows with the upload attached, and the gates of that join."""
    joined = governed.join(checked_broadcast(upload), key, "left")
    after = joined.agg(F.count("*").alias("rows_after"), F.count(probe).alias("matched"),
                       F.count_if(F.col(probe).isNull()).alias("unmatched"))
    before = governed.agg(F.count("*").alias("rows_before"))
    loaded = upload.agg((F.count("*") - F.countDistinct(key)).alias("repeated_keys"))
    stale = (upload.join(governed.select(key).distinct(), key, "left_anti")
             .agg(F.count("*").alias("stale_keys")))
    rows = [df.unpivot([], df.columns, "gate", "value") for df in (before, after, loaded, stale)]
    return joined, reduce(DataFrame.unionByName, rows)
