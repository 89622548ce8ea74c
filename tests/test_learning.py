"""The scores of the learning job against a recount of the scored rows."""

from collections import Counter
from datetime import date

import pytest
from conftest import SF
from pyspark.sql import functions as F

from lakeloom.operators import learning
from lakeloom.plans.campus import Campus
from lakeloom.plans.catalog import loading
from lakeloom.plans.registry import QUERIES

GOOD = [("A", "A")] * 50 + [("A", "B")] * 7 + [("B", "B")] * 20 + [("B", "C")] * 3 + [("C", "A")] * 4 + [("C", "C")] * 6
BAD = [("A", "B")] * 57 + [("B", "C")] * 23 + [("C", "C")] * 10
LEAK = [("A", "A")] * 300 + [("B", "B")] * 100


@pytest.mark.parametrize("rows, no_leak, not_worse", [(GOOD, True, True), (BAD, True, False), (LEAK, False, True)])
def test_scores_and_gates_are_those_of_the_scored_rows(spark, monkeypatch, rows, no_leak, not_worse):
    scored = spark.createDataFrame([(a, float("ABC".index(a)), float("ABC".index(p)), p) for a, p in rows],
                                   "label string, label_ix double, prediction double, predicted string")
    monkeypatch.setattr(loading, "scored", lambda c: scored)
    pairs = Counter(rows)
    actual, predicted = Counter(a for a, _ in rows), Counter(p for _, p in rows)
    f1 = sum(n * 2 * pairs[k, k] / (n + predicted[k]) for k, n in actual.items()) / len(rows)
    got = QUERIES["m04_forest_gates"].run(spark, SF).collect()
    assert len(got) == 1 and got[0].asDict() == {
        "accuracy": pytest.approx(sum(pairs[k, k] for k in actual) / len(rows)), "f1": pytest.approx(f1),
        "majority_rate": pytest.approx(max(actual.values()) / len(rows), abs=1e-6), "total": len(rows), "no_leak": no_leak, "not_worse": not_worse}
    assert {(r.actual, r.predicted): r.n for r in QUERIES["m06_confusion_pairs"].run(spark, SF).collect()} == pairs


def test_scored_rows_are_written_once(spark, monkeypatch):
    forest = learning.forest
    monkeypatch.setattr(learning, "forest", lambda *args: forest(*args, trees=2, depth=2))
    rows = loading.scored(Campus(spark, SF))
    assert all("/scored-" in path for path in rows.inputFiles()) and "UDF" not in rows._jdf.queryExecution().toString()
    assert rows.count() == loading.enrollment_split(Campus(spark, SF)).filter("NOT is_train").count()


def test_forest_rows_are_dealt_evenly(spark, monkeypatch, tmp_path):
    grades = [0] * 3000 + list(range(1, 10)) * 20  # one grade has most rows, and all grades few tasks
    keys = [20 * 10 * k + g for k, g in enumerate(grades)]
    spark.createDataFrame([(k, k % 500, date(1995 + k % 3, 1 + k % 12, 1)) for k in keys], "o_orderkey long, o_custkey long, o_orderdate date").write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(10).withColumnRenamed("id", "p_partkey").write.parquet(f"{tmp_path}/part.parquet")
    spark.range(500).select(F.col("id").alias("c_custkey"), F.lit("BUILDING").alias("c_mktsegment"), F.lit("n").alias("c_name"),
                            F.lit(1).alias("c_nationkey")).write.parquet(f"{tmp_path}/customer.parquet")
    seen = []

    class Stop(Exception):
        pass

    def train(df, *rest):
        seen.extend(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
        raise Stop

    monkeypatch.setattr(learning, "train_and_save", train)
    with pytest.raises(Stop):
        loading.scored(Campus(spark, str(tmp_path)))
    assert sum(seen) == 2400 + 9 * 16 and len(seen) >= spark.sparkContext.defaultParallelism and max(seen) < 1.3 * sum(seen) / len(seen)
