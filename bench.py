"""Time headline queries: one warm-up, then the median of three runs into a sink that keeps nothing.

generated fact of five million rows, written clustered, then summarised,
counted in full and counted by its cluster keys.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from lakeloom.plans import catalog  # noqa: E402, F401
from lakeloom.plans.campus import Campus  # noqa: E402
from lakeloom.plans.catalog.reports import heavy_summary  # noqa: E402
from lakeloom.plans.registry import QUERIES  # noqa: E402
from lakeloom.session import local_session, scratch_path  # noqa: E402
from lakeloom.sinks.tables import write_clustered  # noqa: E402
from lakeloom.sources.generate import generate_fact  # noqa: E402

HEADLINE = [
    "x01_heavy_summary", "x02_student_enriched", "x04_budget_enrollment", "x06_daily_summary",
    "j01_star_join", "j05_two_child_levels", "j07_temporal_price_join", "a10_exact_percentiles", "a17_grade_pivot",
    "a21_department_term_report", "w04_last_enrollment", "w05_rolling_mean", "w09_rank_by_points",
    "c01_snapshot_diff", "c04_scd2", "k10_merge_upsert", "q02_quarantine", "q08_column_profile",
    "g08_filter_and_mask", "g10_rows_visible_all", "t01_run_history", "t05_daily_capacity", "t10_spend_by_product",
    "t12_spend_by_tag",
]


def median(action, runs: int = 3) -> float:
    action()
    took = []
    for _ in range(runs):
        begun = time.perf_counter()
        action()
        took.append(time.perf_counter() - begun)
    return round(statistics.median(took), 3)


def fact_measures(spark, sf_dir: str, rows: int = 5_000_000) -> dict[str, float]:
    campus = Campus(spark, sf_dir)
    made = generate_fact(spark, rows, campus.student, campus.size("part"), 24)
    path = scratch_path(spark, "bench")
    write_clustered(made, path, "term_id", ["dept_id"])
    schema = spark.read.parquet(path).schema

    def fact():
        return spark.read.schema(schema).parquet(path)

    return {
        "heavy_summary": median(lambda: heavy_summary(fact(), campus.department).collect()),
        "full_scan_count": median(lambda: fact().filter(F.col("gpa_points") >= 3.0).count()),
        "clustered_count": median(lambda: fact().filter("term_id = 9 AND dept_id = 5").count()),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> None:
        QUERIES[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()

    took = {name: median(lambda name=name: run(name)) for name in sys.argv[1:] or HEADLINE}
    print(json.dumps({"metric": "headline queries, sum of medians", "value": round(sum(took.values()), 3), "unit": "sec",
                      "queries": took, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1], "fact_5m": fact_measures(spark, sf_dir)}))
    spark.stop()


if __name__ == "__main__":
    main()
