import pytest
from pyspark.sql import functions as F

from lakeloom.operators import cost, joins, learning, quality
from lakeloom.sources.generate import generate_fact, plant


def staged(spark, n=60_000):
    raw = spark.range(1, n + 1).select("id", F.when(F.col("id") % 10 != 9, (F.col("id") % 41 / 10).cast("string")).alias("raw"))
    return plant(raw, "id", {"raw": (5000, F.lit("N/A"))}).withColumn("typed", F.col("raw").try_cast("double"))


def test_rejects_are_the_exact_complement(spark):
    rows = staged(spark)
    valid, rejects = quality.quarantine(rows, F.col("raw").isNotNull() & F.col("typed").isNull())
    assert (valid.count(), rejects.count()) == (59_988, 12)
    kept, metrics = quality.expect_or_drop(rows, "castable", F.col("typed").isNotNull() | F.col("raw").isNull())
    assert kept.count() == 59_988
    assert metrics.get == {"seen": 60_000, "dropped": 12}


def test_null_predicate_counts_as_failed(spark):
    df = spark.createDataFrame([(1,), (None,)], "x int")
    assert quality.expect_or_drop(df, "positive", F.col("x") > 0)[0].count() == 1
    valid, rejects = quality.quarantine(df, F.col("x") > 5)
    assert (valid.count(), rejects.count()) == (2, 0)


def test_drift_flags_shift_only(campus):
    history = campus.history
    same = quality.categorical_drift(history, history, "grade", 0.05).first()
    assert same.distance == 0 and not same.drifted
    shifted = history.withColumn("grade", F.when(F.col("grade") == "A", "F").otherwise(F.col("grade")))
    assert quality.categorical_drift(history, shifted, "grade", 0.05).first().drifted
    assert not quality.numeric_drift(history, history, "gpa_points", 0.05).first().drifted
    lower = history.withColumn("gpa_points", F.col("gpa_points") - 1)
    assert quality.numeric_drift(history, lower, "gpa_points", 0.05).first().drifted


def test_overlapping_prices_are_refused(spark):
    prices = spark.createDataFrame([("a", "2020-01-01", "2021-01-01", 1.0), ("a", "2020-06-01", None, 2.0)],
                                   "sku_name string, price_start string, price_end string, price double")
    prices = prices.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("price_start", "price_end")})
    assert joins.overlapping_windows(prices, "sku_name", "price_start", "price_end").count() == 1
    usage = spark.createDataFrame([("a", 1.0)], "sku_name string, quantity double").withColumn(
        "usage_end", F.lit("2020-07-01").cast("timestamp_ntz"))
    with pytest.raises(ValueError):
        cost.priced(usage, prices, "2020-12-31", 365)


@pytest.mark.parametrize("small", [True, False])
def test_half_open_price_windows(spark, small):
    prices = spark.createDataFrame([("a", "2020-01-01", "2021-01-01", 1.0), ("a", "2021-01-01", None, 2.0)],
                                   "sku string, s string, e string, price double")
    prices = prices.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("s", "e")})
    times = ["2019-12-31 23:59:59", "2020-01-01 00:00:00", "2020-12-31 23:59:59", "2021-01-01 00:00:00", "2024-05-05 00:00:00"]
    facts = spark.createDataFrame([("a", t) for t in times] + [("b", times[1])], "sku string, t string")
    facts = facts.withColumn("t", F.col("t").cast("timestamp_ntz"))
    out = joins.temporal_join(facts, prices, "sku", "t", "s", "e", small=small)
    got = sorted((r.sku, str(r.t), r.price) for r in out.collect())
    assert [g[2] for g in got] == [None, 1.0, 1.0, 2.0, 2.0, None]


def test_gates_report_each_check(spark):
    rows = quality.gates(spark.range(10), {"some": (F.count("*"), F.count("*") > 0), "few": (F.max("id"), F.max("id") < 5)})
    assert {(r.check_name, r.passed, r.value) for r in rows.collect()} == {("some", True, 10.0), ("few", False, 9.0)}


def test_generated_rows_do_not_depend_on_partitioning(spark, campus):
    a = generate_fact(spark, 3000, campus.student, 200, 24)
    spark.conf.set("spark.sql.leafNodeDefaultParallelism", "3")
    try:
        b = generate_fact(spark, 3000, campus.student, 200, 24)
        assert a.exceptAll(b).count() == 0 and b.count() == 3000
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")


def test_split_is_stratified_and_exact(campus):
    split = learning.stratified_split(campus.enrollment, "grade", ["enrollment_id"])
    for r in split.groupBy("grade").agg(F.count("*").alias("n"), F.count_if("is_train").alias("t")).collect():
        assert r.t == int(r.n * 0.8)


def test_untagged_rows_are_kept_on_request(spark):
    df = spark.createDataFrame([({"a": "x", "b": "y"}, 2.0), ({}, 3.0)], "tags map<string,string>, cost double")
    assert {tuple(r) for r in cost.spend_by_tag(df).collect()} == {("a", "x", 2.0), ("b", "y", 2.0)}
    assert (None, None, 3.0) in {tuple(r) for r in cost.spend_by_tag(df, keep_untagged=True).collect()}


def test_overlaps_on_the_chunked_path(spark):
    import random

    rnd = random.Random(5)
    rows = [("hot" if i % 3 else f"k{i % 4}", (s := rnd.randrange(500)), rnd.choice([None, s + rnd.randrange(1, 9)])) for i in range(60)]
    df = spark.createDataFrame(rows, "k string, s int, e int")
    want = set()
    for i, (k, s, _) in enumerate(rows):
        if any(j != i and k2 == k and s2 <= s and (e2 is None or e2 > s) for j, (k2, s2, e2) in enumerate(rows)):
            want.add((k, s))
    for hot in (None, 0):
        got = {(r.k, r.s) for r in joins.overlapping_windows(df, "k", "s", "e", hot).collect()}
        assert got == want


def test_generated_dimension_is_skewed_and_dirty(spark):
    from lakeloom.sources.generate import dirty_dates, generate_dim, weighted

    n = 30_000
    dim = generate_dim(spark, n, {
        "status": weighted(F.col("id"), 1, ["active", "graduated", "leave"], [80, 15, 5]),
        "email": F.concat(F.lit("s"), F.col("id").cast("string")),
        "dob": dirty_dates("id", F.lit("2001-02-03").cast("date"))})
    dirty = plant(dim, "id", {"email": (50, F.lit(None).cast("string"))})
    shares = {r.status: r["count"] / n for r in dirty.groupBy("status").count().collect()}
    assert shares["active"] == pytest.approx(0.8, abs=0.02) and shares["leave"] == pytest.approx(0.05, abs=0.02)
    assert dirty.filter("email IS NULL").count() == n // 50
    assert {r.dob for r in dirty.select("dob").distinct().collect()} == {"2001-02-03", "02/03/2001", "03.02.2001"}


def test_deviation_of_large_values(spark):
    rows = spark.range(1000).select((F.lit(3_000_000_000) + F.col("id")).alias("big"))
    got = quality.profile(rows, ["big"]).first()
    assert abs(got.stddev - rows.agg(F.stddev_samp("big")).first()[0]) < 1e-3


def test_profile_is_one_wide_aggregate(spark):
    rows = spark.range(3000).select((F.col("id") % 7).alias("a"), F.when(F.col("id") % 3 > 0, F.col("id") / 2).alias("b"),
                                    F.concat(F.lit("v"), F.col("id") % 1000).alias("t"), F.lit(None).cast("string").alias("none"))
    got = {r.column_name: r for r in quality.profile(rows, rows.columns, {"a": (1, 5)}).collect()}
    assert [(got[c].row_count, got[c].distinct_count) for c in rows.columns] == [(3000, 7), (3000, 2000), (3000, 1000), (3000, 0)]
    assert got["b"].null_pct == 33.3333 and got["none"].null_pct == 100.0 and got["a"].outliers == rows.filter("a IN (0, 6)").count()
    assert got["t"].mean is None and got["b"].max_value == 1499.5 and got["a"].stddev == round(rows.agg(F.stddev_samp("a")).first()[0], 3)
    quick = quality.profile(rows, rows.columns, exact_distinct=False)
    plan = quick._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and "Expand" not in plan and plan.index("Aggregate") > plan.index("Generate")
    assert all(abs(r.distinct_count - got[r.column_name].distinct_count) <= 0.1 * got[r.column_name].distinct_count for r in quick.collect())
    empty = quality.profile(rows.limit(0), ["a", "t"]).collect()
    assert [(r.row_count, r.null_pct, r.distinct_count, r.mean, r.outliers) for r in empty] == [(0, None, 0, None, 0)] * 2


def test_frequent_values_are_whole_and_exact(spark):
    """A third of all rows on one value, values on the line, a long tail, NULLs and very long values."""
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") < 900, "edge").when(F.col("id") < 1_799, "short").when(F.col("id") % 5 == 1, None)
        .otherwise(F.concat(F.lit("x"), F.col("id"))).alias("t"),
        F.when(F.col("id") % 2 == 0, F.repeat(F.lit("long"), 5000)).otherwise(F.col("id").cast("string")).alias("u"))
    got = quality.frequent_values(rows, ["t", "u"], 0.01)
    want = {(c, r[0], r.n) for c in ("t", "u") for r in rows.filter(f"{c} IS NOT NULL").groupBy(c).agg(F.count("*").alias("n")).filter("n >= 600").collect()}
    assert {(r.column_name, r.value, r.n) for r in got.collect()} == want
    assert {w[1][:5] for w in want} == {"hot", "edge", "longl"}
    assert quality.frequent_values(rows.limit(0), ["t"]).isEmpty()
