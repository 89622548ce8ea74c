"""Spend over usage and price tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.values import exact_total
from lakeloom.operators.aggregates import share
from lakeloom.operators.joins import interval_join
from lakeloom.operators.telemetry import recent


def priced(usage: DataFrame, prices: DataFrame, as_of: str, days: int) -> DataFrame:
    """Usage of a rolling window with the list price valid at its end; unpriced usage keeps a NULL cost.

    Prices that overlap are refused, as spend would be counted twice.
    """
    joined = interval_join(recent(usage, "usage_end", as_of, days), prices, "sku_name", "usage_end", "price_start", "price_end")
    return joined.withColumn("cost", F.col("quantity") * F.col("price"))


def spend(rows: DataFrame, *keys: str, digits: int = 2) -> DataFrame:
    """Spend, units and unpriced rows per key."""
    return rows.groupBy(*keys).agg(
        F.round(exact_total("cost", 4), digits).alias("est_usd"),
        F.sum("quantity").alias("units"),
        F.sum(F.when(F.col("price").isNull(), 1).otherwise(0)).alias("unpriced"))


def cost_driver(sku: Column | str) -> Column:
    """Storage, transfer or compute, by the name of the product."""
    name = F.upper(F.col(sku) if isinstance(sku, str) else sku)
    return (F.when(name.contains("STORAGE"), "storage")
            .when(name.contains("EGRESS") | name.contains("INTER_REGION"), "transfer").otherwise("compute"))


def spend_by_tag(rows: DataFrame, tags: str = "tags", keep_untagged: bool = False) -> DataFrame:
    """Spend per tag key and value; a row counts once for each of its tags."""
    unfold = F.explode_outer if keep_untagged else F.explode
    return (rows.select(unfold(tags).alias("tag_key", "tag_value"), "cost")
            .groupBy("tag_key", "tag_value").agg(F.round(exact_total("cost", 4), 2).alias("est_usd")))


def scaling(events: DataFrame) -> DataFrame:
    """Scaling behaviour per warehouse."""
    return events.groupBy("warehouse_id").agg(
        F.count("*").alias("event_count"), F.max("cluster_count").alias("max_clusters"),
        F.sum(F.when(F.col("event_type") == "SCALED_UP", 1).otherwise(0)).alias("scale_ups"))


def idle(all_ids: DataFrame, events: DataFrame, key: str, as_of: str, days: int) -> DataFrame:
    """Ids without an event in the window."""
    recent = events.filter(F.col("event_time") >= F.date_sub(F.lit(as_of).cast("date"), days))
    return all_ids.select(key).distinct().join(recent.select(key).distinct(), key, "left_anti")


def budget_status(spent: DataFrame, budget: float, warn: float = 0.9, over: float = 1.1) -> DataFrame:
    """Percent of budget with a status (T14); ``spent`` has a column ``spend``."""
    pct = F.col("spend") / F.lit(budget)
    status = F.when(pct > over, "OVER BUDGET").when(pct > warn, "WARNING").otherwise("OK")
    return spent.withColumn("budget", F.lit(float(budget))).withColumn(
        "pct_of_budget", F.round(pct * 100, 1)).withColumn("budget_status", status)


def month_end(rows: DataFrame, day: str, cost: str, as_of: str) -> DataFrame:
    """Spend so far this month and its straight-line projection."""
    today = F.lit(as_of).cast("date")
    month = rows.filter((F.col(day) >= F.trunc(today, "MM")) & (F.col(day) <= today))
    burn = F.col("to_date") / F.dayofmonth(today)
    return month.agg(exact_total(cost, 4).alias("to_date")).select(
        F.round("to_date", 2).alias("spend_to_date"), F.round(burn, 2).alias("daily_burn"),
        F.round(burn * F.dayofmonth(F.last_day(today)), 2).alias("projected"))


def forecast(daily: DataFrame, series: str, day: str, value: str, horizon: int = 30, z: float = 1.645) -> DataFrame:
    """Linear trend per series for the next ``horizon`` days with a band.

    A least-squares line from one mergeable aggregate; the band is the residual
    deviation times ``z`` (1.645 covers 90 percent of a normal residual).
    """
    x = F.datediff(F.col(day).cast("date"), F.lit("1970-01-01").cast("date")).cast("double")
    y = F.col(value)
    fit = daily.withColumn("_x", x).groupBy(series).agg(
        F.regr_slope(y, F.col("_x")).alias("slope"), F.regr_intercept(y, F.col("_x")).alias("base"),
        F.regr_syy(y, F.col("_x")).alias("syy"), F.regr_sxy(y, F.col("_x")).alias("sxy"),
        F.count("*").alias("n"), F.max(day).alias("last"))
    left = F.greatest(F.col("syy") - F.col("slope") * F.col("sxy"), F.lit(0.0))
    sd = F.sqrt(left / F.nullif(F.col("n") - 2, F.lit(0)))
    ahead = fit.withColumn("sd", sd).withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    date = F.date_add(F.col("last").cast("date"), F.col("h"))
    at = F.col("base") + F.col("slope") * F.datediff(date, F.lit("1970-01-01").cast("date"))
    return ahead.select(series, date.alias("day"), F.round(at, 2).alias("forecast"),
                        F.round(at - z * F.col("sd"), 2).alias("low"), F.round(at + z * F.col("sd"), 2).alias("high"))


def weekday_forecast(daily: DataFrame, series: str, day: str, value: str, horizon: int = 30, z: float = 1.645) -> DataFrame:
    """Linear trend and weekday effects per series for the next ``horizon`` days, with a prediction band.

    ``daily`` has one row per series and day. Least squares from sums per
    (series, weekday), which combine on the map side: the slope pools the
    deviations within weekdays, a weekday's level is its own mean on that slope.
    The band holds one further day: residual variance, doubt of the level and
    doubt of the slope, so it widens with the horizon; ``z`` is a normal
    quantile (1.645 for 90 percent), corrected to Student's t for few days.
    A weekday that a series has never seen has a NULL forecast, a series with
    too few days to judge its residuals a NULL band.
    """
    number = lambda date: F.datediff(date, F.lit("1970-01-01").cast("date")).cast("double")
    x, y = F.col("_x"), F.col(value)
    dated = daily.filter(F.col(day).isNotNull() & y.isNotNull()).withColumn("_x", number(F.col(day).cast("date")))
    levels = dated.groupBy(series, F.weekday(F.col(day).cast("date")).alias("_wd")).agg(
        F.count("*").alias("n"), F.avg(x).alias("mx"), F.avg(y).alias("my"), F.regr_sxx(y, x).alias("sxx"),
        F.regr_sxy(y, x).alias("sxy"), F.regr_syy(y, x).alias("syy"), F.max(F.col(day).cast("date")).alias("last"))
    spread = F.nullif(F.sum("sxx"), F.lit(0.0))
    fit = levels.groupBy(series).agg(
        (F.sum("sxy") / spread).alias("slope"), spread.alias("spread"), (F.sum("syy") - F.pow(F.sum("sxy"), F.lit(2)) / spread).alias("rest"),
        (F.sum("n") - F.count("*") - 1).alias("df"), F.max("last").alias("last"),
        F.collect_list(F.struct("_wd", "n", "mx", "my")).alias("levels"))  # at most seven
    ahead = fit.withColumn("_day", F.explode(F.sequence(F.date_add("last", 1), F.date_add("last", horizon))))
    level = F.get(F.filter("levels", lambda one: one["_wd"] == F.weekday(F.col("_day"))), 0)
    off = number(F.col("_day")) - level["mx"]
    at = level["my"] + F.col("slope") * off
    df = F.when(F.col("df") > 0, F.col("df"))
    t = (F.lit(z) + (z ** 3 + z) / 4 / df + (5 * z ** 5 + 16 * z ** 3 + 3 * z) / 96 / F.pow(df, F.lit(2))
         + (3 * z ** 7 + 19 * z ** 5 + 17 * z ** 3 - 15 * z) / 384 / F.pow(df, F.lit(3)))
    sd = F.sqrt(F.greatest(F.col("rest"), F.lit(0.0)) / df * (1 + 1 / level["n"] + F.pow(off, F.lit(2)) / F.col("spread")))
    return ahead.select(series, F.col("_day").alias("day"), F.round(at, 2).alias("forecast"),
                        F.round(at - t * sd, 2).alias("low"), F.round(at + t * sd, 2).alias("high"))


def chargeback(weights: DataFrame, rows: DataFrame, cost: str) -> DataFrame:
    """Split total spend by given weights (T17, J15); the total is a scalar, not a join side."""
    total = rows.agg(exact_total(cost, 4)).scalar()
    return weights.select("department", "weight", F.round(F.col("weight") * total, 2).alias("allocated_usd"))


def service_shares(rows: DataFrame, key: str) -> DataFrame:
    """Spend per service with its share of the total."""
    return share(spend(rows, key).select(key, "est_usd", "units"), "est_usd", "pct_of_total")


def monthly(rows: DataFrame, day: str) -> DataFrame:
    """Spend and active days per month."""
    return rows.groupBy(F.trunc(F.col(day), "MM").alias("month")).agg(
        F.round(exact_total("cost", 4), 2).alias("monthly_usd"),
        F.countDistinct(F.col(day).cast("date")).alias("days_active"))
