"""What the plans must look like."""

import pytest
from pyspark.sql import functions as F

from lakeloom.operators.joins import split_join
from lakeloom.operators.sizing import attach, checked_broadcast, fits_broadcast
from lakeloom.plans import catalog  # noqa: F401  (registers the queries)
from lakeloom.plans.registry import QUERIES
from lakeloom.sinks import tables
from conftest import SF


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dimension_is_broadcast(campus):
    joined = campus.history.join(checked_broadcast(campus.department), "dept_id")
    assert "BroadcastHashJoin" in plan(joined)


def test_size_check(spark):
    assert fits_broadcast(spark.range(100))
    assert not fits_broadcast(spark.range(101), rows=100)
    assert not fits_broadcast(spark.range(100).withColumn("s", F.repeat(F.lit("x"), 1000)), size=50_000)
    assert "ResolvedHint" not in checked_broadcast(spark.range(101), rows=100)._jdf.queryExecution().analyzed().toString()


def test_scan_reads_needed_columns_only(spark):
    text = plan(QUERIES["a01_count_per_term"].run(spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint>" in text and "l_comment" not in text


def test_mark_reaches_the_scan(spark):
    assert "GreaterThan(o_orderdate" in plan(QUERIES["s17_changed_since"].run(spark, SF))


def test_keyset_page_reaches_the_scan(spark):
    text = plan(QUERIES["s11_keyset_page"].run(spark, SF))
    assert "GreaterThan(o_orderkey,777)" in text and "TakeOrderedAndProject" in text


def test_row_filter_joins_mapped_values(spark):
    text = plan(QUERIES["g05_row_filter"].run(spark, SF))
    assert "LeftOuter" in text and "NestedLoop" not in text and "Subquery" in text


def test_sql_filter_function_is_an_existence_join(spark):
    text = plan(QUERIES["d02_sql_filter_function"].run(spark, SF))
    assert "ExistenceJoin" in text and "NestedLoop" not in text


def test_top_k_is_not_a_full_sort(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["l01_top_students"].run(spark, SF))


def test_temporal_join_by_month_is_an_equi_join(spark):
    text = plan(QUERIES["j07_temporal_price_join_by_month"].run(spark, SF))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_bucketed_tables_join_without_shuffle(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a = tables.write_bucketed(spark.range(1000).withColumn("x", F.lit(1)), "plan_a", str(tmp_path / "a"), ["id"], 4)
        b = tables.write_bucketed(spark.range(1000).withColumn("y", F.lit(1)), "plan_b", str(tmp_path / "b"), ["id"], 4)
        assert "Exchange" not in plan(a.join(b, "id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_clustered_fact_prunes_directories(spark, campus, tmp_path):
    fact = tables.write_clustered(campus.history.select("enrollment_id", "term_id", "dept_id"), str(tmp_path / "f"), "term_id", ["dept_id"])
    hit = fact.filter("term_id = 9 AND dept_id = 5")
    assert "PartitionFilters: [isnotnull(term_id" in plan(hit)
    hit.collect()
    read = hit.select(F.input_file_name().alias("f")).distinct().collect()
    assert read and all("term_id=9" in r.f for r in read)


def test_hot_key_is_split_when_joined_back(spark):
    """The shape adaptive execution needs: a shuffle directly below each join side."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2.0",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
                "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(200_000).withColumn("k", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 997)).withColumn(
            "pad", F.md5(F.col("id").cast("string")))
        joined = attach(rows, rows.groupBy("k").agg(F.count("*").alias("n")), ["k"])
        assert len(joined.collect()) == 200_000
        assert "skew=true" in plan(joined)
    finally:
        for k in settings:
            spark.conf.unset(k)


def test_no_cartesian_products_anywhere(spark):
    for name, q in QUERIES.items():
        if name[:1] in "jatwqgxclupfd":  # others write and read files, and so have no plan of their own
            text = plan(q.run(spark, SF))
            assert "CartesianProduct" not in text, name
            assert "BroadcastNestedLoopJoin" not in text, name


def test_split_join_sides_add_up(campus):
    active = campus.student.filter("status = 'active'").select("student_id")
    both, left, _ = split_join(campus.enrollment.select("student_id"), active, "student_id")
    assert both.count() + left.count() == campus.enrollment.count()


@pytest.mark.parametrize("name", ["x01_heavy_summary", "t10_spend_by_product", "a21_department_term_report"])
def test_headline_queries_stay_in_the_jvm(spark, name):
    text = plan(QUERIES[name].run(spark, SF))
    assert "Python" not in text and "Pandas" not in text


@pytest.mark.parametrize("name", ["t05_daily_capacity", "t06_hourly_utilisation", "t07_week_workload", "t08_tier_distribution"])
def test_log_window_reaches_the_scan(spark, name):
    text = plan(QUERIES[name].run(spark, SF))
    assert "GreaterThanOrEqual(ts,2024-01-" in text and "LessThan(ts,2024-0" in text


def test_idle_warehouses_without_queries_are_found(spark):
    from lakeloom.operators.telemetry import idle_share

    history = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-09 10:00:00' AS start_time, named_struct('warehouse_id', 'a') AS compute")
    got = {(str(r.week), r.warehouse_id, r.busy_hours) for r in idle_share(
        history, "2024-01-14", 13, spark.createDataFrame([("a",), ("b",)], "warehouse_id string"), 0.02).collect()}
    assert got == {("2024-01-01", "a", 0), ("2024-01-08", "a", 1), ("2024-01-01", "b", 0), ("2024-01-08", "b", 0)}
