"""Run history, capacity and workload over log tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions import fixed
from lakeloom.functions.dates import minutes_between, seconds_between
from lakeloom.functions.text import squeeze
from lakeloom.functions.values import below, run_status, throttled
from lakeloom.operators.aggregates import collapse_timeline
from lakeloom.operators.ordered import exact_percentiles
from lakeloom.operators.windows import latest_per_key


def recent(log: DataFrame, ts: str, as_of: str, days: int) -> DataFrame:
    """The rolling window that every log operator starts from: the day ``as_of`` and the ``days`` before it (P10).

    A plain comparison with dates, so it reaches the scan before anything is shuffled.
    """
    day = F.lit(as_of).cast("date")
    return log.filter((F.col(ts) >= F.date_sub(day, days).cast("timestamp_ntz")) & (F.col(ts) < F.date_add(day, 1).cast("timestamp_ntz")))


def current_names(dim: DataFrame, key: str) -> DataFrame:
    """Current name of each renamed object, deleted versions excluded."""
    live = dim.filter(F.col("delete_time").isNull()).select(key, "name", "change_time")
    return latest_per_key(live, [key], ["change_time", "name"]).select(key, "name")


def timeline_runs(periods: DataFrame, dim: DataFrame, key: str, run: str, kind: str, as_of: str, days: int) -> DataFrame:
    """Finished runs of one workload type with their current name.

    Periods are collapsed before the name is joined, so the join moves one row per run.
    """
    periods = recent(periods, "period_start", as_of, days)
    runs = collapse_timeline(periods, [key, run], "period_start", "period_end", "result_state")
    named = runs.filter(F.col("raw_state").isNotNull()).join(current_names(dim, key), key)
    return named.select(F.lit(kind).alias("workload_type"), "name",
                        F.col(run).cast("string").alias("run_id"), "start_time", "end_time", "raw_state")


def statement_runs(history: DataFrame, as_of: str, days: int, width: int = 40) -> DataFrame:
    """Notebook statements in the same shape as runs."""
    history = recent(history, "start_time", as_of, days)
    return history.filter(F.col("notebook_id").isNotNull()).select(
        F.lit("Notebook").alias("workload_type"),
        F.concat(F.lit("Notebook: "), squeeze("statement_text", width)).alias("name"),
        F.col("statement_id").cast("string").alias("run_id"), "start_time", "end_time",
        F.col("execution_status").alias("raw_state"))


def run_history(parts: list[DataFrame]) -> DataFrame:
    """All workload types in one shape with status and duration."""
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return (union.withColumn("status", run_status("raw_state"))
            .withColumn("duration_min", minutes_between(F.col("start_time"), F.col("end_time"))))


def run_kpis(runs: DataFrame) -> DataFrame:
    """Total, succeeded, failed and success percentage."""
    ok = F.sum(F.when(F.col("status") == "Succeeded", 1).otherwise(0))
    bad = F.sum(F.when(F.col("status") == "Failed", 1).otherwise(0))
    return runs.agg(F.count("*").alias("total_runs"), ok.alias("succeeded"), bad.alias("failed"),
                    F.round(ok * 100.0 / F.count("*"), 1).alias("success_pct"))


def task_runs(periods: DataFrame, dim: DataFrame, as_of: str, days: int) -> DataFrame:
    """One row per finished task run with job name and duration."""
    periods = recent(periods, "period_start", as_of, days)
    tasks = collapse_timeline(periods, ["job_id", "run_id", "task_key"], "period_start", "period_end", "result_state")
    done = tasks.filter(F.col("raw_state").isNotNull()).join(current_names(dim, "job_id"), "job_id")
    return done.select("name", "run_id", "task_key", F.col("raw_state").alias("result_state"), "start_time",
                       minutes_between(F.col("start_time"), F.col("end_time")).alias("duration_min"))


def breaches(runs: DataFrame, seconds: int) -> DataFrame:
    """Runs longer than the agreed time."""
    took = seconds_between(F.col("start_time"), F.col("end_time"))
    return runs.withColumn("seconds", took).filter(F.col("seconds") > seconds)


def tier(ms: Column | str) -> Column:
    return below(ms, fixed.TIERS, fixed.LAST_TIER)


def latency_bucket(ms: Column | str) -> Column:
    return below(ms, fixed.BUCKETS, fixed.LAST_BUCKET)


def _load(*extra: Column) -> list[Column]:
    return [F.count("*").alias("query_count"), F.round(F.avg("total_duration_ms"), 0).alias("avg_ms"),
            F.sum(throttled("waiting_ms")).alias("throttled"), *extra]


def daily_capacity(history: DataFrame, as_of: str, days: int) -> DataFrame:
    """Per day and warehouse: volume, latency, exact 95th percentile, queueing."""
    history = recent(history, "start_time", as_of, days)
    keys = ["query_date", "warehouse_id"]
    rows = history.filter(F.col("compute.warehouse_id").isNotNull()).select(
        F.col("start_time").cast("date").alias("query_date"), F.col("compute.warehouse_id").alias("warehouse_id"),
        "total_duration_ms", "waiting_ms")
    base = rows.groupBy(*keys).agg(*_load(F.round(F.avg("waiting_ms"), 0).alias("avg_queue_ms")))
    p95 = exact_percentiles(rows, keys, "total_duration_ms", {"p95": 0.95})
    return base.join(p95.select(*keys, F.round("p95", 2).alias("p95_ms")), keys)


def hourly_use(history: DataFrame, as_of: str, days: int) -> DataFrame:
    """Queries per hour and warehouse."""
    history = recent(history, "start_time", as_of, days)
    hour = F.date_trunc("HOUR", F.col("start_time")).cast("timestamp_ntz")
    return (history.filter(F.col("compute.warehouse_id").isNotNull())
            .groupBy(hour.alias("hour"), F.col("compute.warehouse_id").alias("warehouse_id")).agg(*_load()))


def user_load(history: DataFrame, as_of: str, days: int) -> DataFrame:
    """Who drives the load."""
    history = recent(history, "start_time", as_of, days)
    return history.groupBy(F.col("executed_by").alias("user_name")).agg(
        *_load(F.sum("read_rows").alias("rows_read")))


def tiers(history: DataFrame, as_of: str, days: int) -> DataFrame:
    history = recent(history, "start_time", as_of, days)
    return history.groupBy(tier("total_duration_ms").alias("perf_tier")).agg(F.count("*").alias("queries"))


def latency_histogram(history: DataFrame, as_of: str, days: int) -> DataFrame:
    history = recent(history, "start_time", as_of, days)
    return history.groupBy(latency_bucket("total_duration_ms").alias("bucket")).agg(
        F.count("*").alias("query_count"), F.round(F.avg("read_rows"), 2).alias("avg_rows"),
        F.round(F.avg("total_duration_ms"), 2).alias("avg_ms"))


def query_costs(history: DataFrame, as_of: str, days: int, rates: dict[str, float]) -> DataFrame:
    """Cost of each query at hourly rates, and per row read."""
    history = recent(history, "start_time", as_of, days)
    hours = F.col("total_duration_ms") / 3600000.0
    first = next(iter(rates.values()))
    return history.filter(F.col("read_rows") > 0).select(
        "statement_id", "total_duration_ms", "read_rows",
        *[F.round(hours * rate, 6).alias(f"cost_{name}") for name, rate in rates.items()],
        F.round(hours * first / F.col("read_rows"), 9).alias("cost_per_row"))


def user_costs(history: DataFrame, as_of: str, days: int, rate: float) -> DataFrame:
    """Estimated cost per user."""
    history = recent(history, "start_time", as_of, days)
    return history.groupBy(F.col("executed_by").alias("user_name")).agg(
        F.countDistinct("statement_id").alias("query_count"),
        F.round(F.avg("total_duration_ms"), 2).alias("avg_ms"),
        F.round(F.sum("total_duration_ms") / 3600000.0 * rate, 4).alias("estimated_cost"))


def slow_queries(history: DataFrame, as_of: str, days: int, ms: int, rate: float, n: int) -> DataFrame:
    """The n slowest statements above a limit."""
    history = recent(history, "start_time", as_of, days)
    return (history.filter(F.col("total_duration_ms") > ms)
            .select("statement_id", F.col("executed_by").alias("user_name"), "total_duration_ms",
                    F.substring("statement_text", 1, 100).alias("snippet"),
                    F.round(F.col("total_duration_ms") / 3600000.0 * rate, 4).alias("query_cost"))
            .orderBy(F.desc("total_duration_ms"), "statement_id").limit(n))


def statements_like(history: DataFrame, as_of: str, days: int, pattern: str) -> DataFrame:
    """Statistics of statements whose text matches."""
    history = recent(history, "start_time", as_of, days)
    return history.filter(F.col("statement_text").ilike(pattern)).select(
        "statement_id", "executed_by", "execution_status", "total_duration_ms", "read_rows")


def alerts(history: DataFrame, as_of: str, days: int, slow_ms: int, slow_limit: int, volume_limit: int) -> DataFrame:
    """Days on which a warehouse ran too many slow queries or too many at all."""
    history = recent(history, "start_time", as_of, days)
    per_day = history.groupBy(F.col("start_time").cast("date").alias("query_date"),
                              F.col("compute.warehouse_id").alias("warehouse_id")).agg(
        F.count("*").alias("volume"), F.sum(F.when(F.col("total_duration_ms") > slow_ms, 1).otherwise(0)).alias("slow"))
    found = F.array_compact(F.array(
        F.when(F.col("slow") > slow_limit, F.struct(F.lit("slow_queries").alias("alert"), F.col("slow").alias("value"))),
        F.when(F.col("volume") > volume_limit,
               F.struct(F.lit("query_volume").alias("alert"), F.col("volume").alias("value")))))
    return per_day.select("query_date", "warehouse_id", F.explode(found).alias("a")).select(
        "query_date", "warehouse_id", "a.alert", "a.value")


def idle_share(history: DataFrame, as_of: str, days: int, warehouses: DataFrame, limit: float) -> DataFrame:
    """Warehouses idle for more than ``limit`` of the hours of a week, those without any query included."""
    start = F.col("start_time")
    busy = recent(history, "start_time", as_of, days).select(
        F.date_trunc("WEEK", start).cast("date").alias("week"), F.col("compute.warehouse_id").alias("warehouse_id"),
        F.date_trunc("HOUR", start).alias("hour")).groupBy("week", "warehouse_id").agg(F.countDistinct("hour").alias("busy_hours"))
    first, last = (F.date_trunc("WEEK", d).cast("date") for d in (F.date_sub(F.lit(as_of).cast("date"), days), F.lit(as_of).cast("date")))
    weeks = warehouses.select("warehouse_id").distinct().withColumn("week", F.explode(F.sequence(first, last, F.expr("INTERVAL 7 DAY"))))
    return (weeks.join(busy, ["week", "warehouse_id"], "left")
            .withColumn("busy_hours", F.coalesce("busy_hours", F.lit(0)).cast("long"))
            .withColumn("idle_share", F.round(1 - F.col("busy_hours") / 168.0, 4))
            .filter(F.col("idle_share") > limit))
