"""Composite jobs, run telemetry and cost."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.functions import dates, text, values
from lakeloom.operators import aggregates, cost, joins, ordered, sketches, telemetry, windows
from lakeloom.plans.campus import Campus
from lakeloom.plans.catalog.core import GPA4, STAR_NEEDS, STAR_SQL, avg_sql, star
from lakeloom.plans.oracle import BUCKET, STANDING, TIER
from lakeloom.plans.registry import query
from lakeloom.session import durable

# -- X: composite jobs --------------------------------------------------------


@query("X01", f"""SELECT division, dept_id, term_id, count(*) AS enrollments, {GPA4} AS avg_gpa,
    count(DISTINCT student_id) AS distinct_students, rank() OVER (PARTITION BY term_id ORDER BY count(*) DESC) AS dept_rank_in_term
    FROM history JOIN department USING (dept_id) WHERE gpa_points IS NOT NULL GROUP BY 1, 2, 3""", "history department")
def x01_heavy_summary(c: Campus):
    return heavy_summary(c.history, c.department)


def heavy_summary(fact, department):
    """Grouped by key before the dimension joins, so names never travel with the fact."""
    graded = fact.filter(F.col("gpa_points").isNotNull())
    ranked = windows.rank_aggregate(
        graded, ["dept_id", "term_id"],
        {"enrollments": F.count("*"), "avg_gpa": values.exact_avg("gpa_points", 1, 4),
         "distinct_students": F.countDistinct("student_id")},
        ["term_id"], "enrollments", "dept_rank_in_term")
    return (ranked.join(department.select("dept_id", "division"), "dept_id")
            .withColumn("dept_rank_in_term", F.col("dept_rank_in_term").cast("long"))
            .orderBy("term_id", "dept_rank_in_term", "dept_id"))


@query("X02 J02 P04", f"""SELECT s.student_id, upper(last_name) || ', ' || upper(first_name[1]) || lower(first_name[2:]) AS full_name,
    CASE WHEN email IS NOT NULL THEN split_part(email, '@', 2) END AS email_domain, d.name AS dept_name, 'matched' AS dept_match,
    coalesce(a.total, 0.0)::DOUBLE AS aid_amount, {STANDING} AS standing, status FROM student s LEFT JOIN department d USING (dept_id)
    LEFT JOIN (SELECT student_id, sum(round(amount * 100)::BIGINT)::DOUBLE / 100 AS total FROM aid GROUP BY 1) a ON a.student_id = s.student_id""",
       "student department aid")
def x02_student_enriched(c: Campus):
    dept = c.department.select("dept_id", F.col("name").alias("dept_name"))
    aid = c.aid.groupBy("student_id").agg(values.exact_total("amount").alias("total_aid"))
    return joins.enrich(c.student, dept, "dept_id", "dept_name", "dept_match").join(aid, "student_id", "left").select(
        "student_id", text.formal_name("last_name", "first_name").alias("full_name"),
        text.after("email", "@").alias("email_domain"), "dept_name", "dept_match",
        F.coalesce("total_aid", F.lit(0.0)).alias("aid_amount"), values.standing("status").alias("standing"), "status")


@query("X03", """SELECT student_id, dob, born AS dob_parsed, year(born)::INTEGER AS birth_year, dayname(born) AS birth_dow,
    floor((DATE '2024-09-01' - born) / 365.25::DOUBLE)::INTEGER AS age_years,
    TIMESTAMP '2024-09-01 12:30:00' AS load_ts_utc, TIMESTAMP '2024-09-01 08:30:00' AS load_ts_eastern, TIMESTAMP '2024-09-01 05:30:00' AS load_ts_pacific FROM student""", "student")
def x03_student_dates(c: Campus):
    loaded = F.lit("2024-09-01 12:30:00").cast("timestamp_ntz")
    born = dates.parse_mixed_date("dob")
    return c.student.select(
        "student_id", "dob", born.alias("dob_parsed"), F.year(born).alias("birth_year"), dates.weekday(born).alias("birth_dow"),
        dates.age_years(born, "2024-09-01").alias("age_years"), loaded.alias("load_ts_utc"), dates.in_zone(loaded, "America/New_York").alias("load_ts_eastern"),
        dates.in_zone(loaded, "America/Los_Angeles").alias("load_ts_pacific"))


@query("X04 J10 J16 P01 P02", """WITH f AS (SELECT e.*, b.dept_name, b.budget_amount, b.approved_date FROM enrollment e JOIN course c USING (course_id)
      JOIN student s ON e.student_id = s.student_id JOIN budget b ON c.dept_id = b.dept_id WHERE s.status = 'active'),
    n AS (SELECT dept_name, count(DISTINCT student_id) AS n FROM f GROUP BY 1)
    SELECT f.dept_name AS department, budget_amount AS total_budget, approved_date AS budget_approved, enrollment_id, student_id,
      course_id, term_id, grade, gpa_points, round(budget_amount::DOUBLE / n.n, 2) AS budget_per_student
    FROM f JOIN n USING (dept_name)""", "enrollment course student budget")
def x04_budget_enrollment(c: Campus):
    """Students are counted per department first, so the budgets meet the fact in one join."""
    facts = (c.enrollment.join(c.course.select("course_id", "dept_id"), "course_id")
             .join(c.student.filter(F.col("status") == "active").select("student_id"), "student_id"))
    students = facts.select("dept_id", "student_id").groupBy("dept_id").agg(F.countDistinct("student_id").alias("_students"))
    budgets = durable(c.budget.withColumnsRenamed({"dept_name": "department", "budget_amount": "total_budget", "approved_date": "budget_approved"})
                      .join(students, "dept_id", "left"), "budgets")
    return (facts.join(budgets, "dept_id")
            .withColumn("budget_per_student", F.round(F.col("total_budget") / F.col("_students"), 2)).drop("_students", "dept_id"))


EXPORT_SQL = """SELECT enrollment_id, s.student_id, first_name || ' ' || last_name AS student_name, course_id, title AS course_title,
    term_id, star.year, season, grade, gpa_points, department FROM star JOIN student s USING (student_id) JOIN (SELECT course_id, title FROM course) USING (course_id)"""


def enrollment_export(c: Campus, limit: int | None):
    """Newest years first, at most ``limit`` rows; all rows, unordered, without one."""
    named = c.student.select("student_id", text.display_name("first_name", "last_name").alias("student_name"))
    titled = c.course.select("course_id", F.col("title").alias("course_title"))
    rows = star(c).filter(values.all_of([None, None])).join(named, "student_id").join(titled, "course_id").drop("dept_id")
    return rows if limit is None else windows.top(rows, [F.desc("year"), F.col("enrollment_id")], limit)


@query("X05 J01 P03 L02", f"WITH {STAR_SQL} {EXPORT_SQL} ORDER BY year DESC, enrollment_id LIMIT 10000", STAR_NEEDS + " student")
def x05_enrollment_export(c: Campus):
    """The interactive export: the limit is its guardrail."""
    return enrollment_export(c, 10_000)


@query("X05 J01", f"WITH {STAR_SQL} {EXPORT_SQL}", STAR_NEEDS + " student")
def x05_full_export(c: Campus):
    return enrollment_export(c, None)


def daily_summary(c: Campus, run_date: str):
    """One row about the whole fact, which is read once: grades travel as counts of their few values."""
    slim = durable(c.history.select("student_id", "course_id", "gpa_points"), "slim")
    distinct = slim.agg(F.countDistinct("student_id").alias("unique_students"), F.countDistinct("course_id").alias("unique_courses"))
    counts = durable(slim.groupBy("gpa_points").agg(F.count("*").alias("n")), "grades")
    tenths = F.round(F.col("gpa_points") * 10).cast("long")  # grades have one decimal
    graded = F.sum(F.when(F.col("gpa_points").isNotNull(), F.col("n")))
    totals = counts.agg(F.sum("n").alias("total_enrollments"), F.round(F.sum(tenths * F.col("n")) / graded / 10, 4).alias("avg_gpa"),
                        F.coalesce(F.sum(F.when(F.col("gpa_points").isNull(), F.col("n"))), F.lit(0)).alias("withdrawals"))
    median = ordered.exact_percentiles(slim, [], "gpa_points", {"m": 0.5})
    return totals.select(F.lit(run_date).cast("date").alias("run_date"), "total_enrollments",
                         distinct.select("unique_students").scalar().alias("unique_students"), distinct.select("unique_courses").scalar().alias("unique_courses"),
                         "avg_gpa", "withdrawals", F.round(median.select("m").scalar(), 4).alias("median_gpa"))


@query("X06 A06 A09 K02", f"""SELECT DATE '2024-02-01' AS run_date, count(*) AS total_enrollments, count(DISTINCT student_id) AS unique_students,
    count(DISTINCT course_id) AS unique_courses, {GPA4} AS avg_gpa, round(quantile_cont(gpa_points, 0.5), 4) AS median_gpa,
    sum(CASE WHEN gpa_points IS NULL THEN 1 ELSE 0 END)::BIGINT AS withdrawals FROM history""", "history")
def x06_daily_summary(c: Campus):
    """Loaded twice for the same date: still one row."""
    from lakeloom.session import scratch_path
    from lakeloom.sinks.tables import replace_partition

    path = scratch_path(c.spark, "daily")
    row = durable(daily_summary(c, "2024-02-01"), "daily")
    replace_partition(row, path, "run_date")
    return replace_partition(row, path, "run_date")


def kept_days(c: Campus):
    """The query log sketched by day and warehouse, and stored by day."""
    from lakeloom.session import scratch_path
    from lakeloom.sinks.tables import replace_partition

    rows = c.query_history.select(F.col("start_time").cast("date").alias("day"), "compute.warehouse_id", "total_duration_ms", "executed_by")
    days = sketches.daily_sketches(rows, "day", ["warehouse_id"], ["total_duration_ms"], ["executed_by"])
    return rows, replace_partition(days, scratch_path(c.spark, "sketches"), "day")


@query("X06 A09 A22", """SELECT warehouse_id, count(*) AS n_rows, count(DISTINCT executed_by) AS exact_users, true AS median_holds, true AS users_hold
    FROM query_history GROUP BY 1""", "query_history")
def x06_sketched_days(c: Campus):
    """Merged days held against the facts: the median's rank and the distinct count stay within the stated errors."""
    rows, stored = kept_days(c)
    found = sketches.estimates(sketches.merge_days(stored, "day", ["warehouse_id"]), {"mid": ("total_duration_ms", 0.5)}, {"users": "executed_by"})
    exact = rows.groupBy("warehouse_id").agg(F.countDistinct("executed_by").alias("exact_users"))
    values_by_key = rows.groupBy("warehouse_id", "total_duration_ms").agg(F.count("total_duration_ms").alias("n"))
    found = found.withColumnRenamed("warehouse_id", "_w")
    ranks = values_by_key.join(found.select("_w", "mid"), F.col("warehouse_id").eqNullSafe(F.col("_w"))).groupBy("warehouse_id").agg(
        (F.sum(F.when(F.col("total_duration_ms") < F.col("mid"), F.col("n")).otherwise(0)) / F.sum("n")).alias("low"),
        (F.sum(F.when(F.col("total_duration_ms") <= F.col("mid"), F.col("n")).otherwise(0)) / F.sum("n")).alias("high"))
    joined = found
    for side, key in ((exact, "_e"), (ranks, "_r")):
        joined = joined.join(side.withColumnRenamed("warehouse_id", key), F.col("_w").eqNullSafe(F.col(key)))
    return joined.select(F.col("_w").alias("warehouse_id"), "n_rows", "exact_users",
                         F.expr(f"low - {sketches.RANK_ERROR} <= 0.5 AND high + {sketches.RANK_ERROR} >= 0.5").alias("median_holds"),
                         (F.abs(F.col("users") - F.col("exact_users")) <= F.col("exact_users") * sketches.COUNT_ERROR).alias("users_hold"))


@query("A09 A22")
def a09_rolling_week(c: Campus):
    """Approximate median latency and active users of the seven days that end with each day, from stored sketches alone."""
    _, stored = kept_days(c)
    week = sketches.rolling_days(stored, "day", ["warehouse_id"], 7)
    return sketches.estimates(week, {"median_ms": ("total_duration_ms", 0.5), "p95_ms": ("total_duration_ms", 0.95)}, {"users": "executed_by"})


@query("X07 K14", """SELECT 'by_dept' AS leg, count(*) AS n_groups, sum(n)::BIGINT AS total, true AS agree FROM (SELECT dept_id, count(*) AS n FROM history GROUP BY 1)
    UNION ALL SELECT 'by_term', count(*), sum(n)::BIGINT, true FROM (SELECT term_id, count(*) AS n FROM history GROUP BY 1)""", "history")
def x07_stage_legs_merge(c: Campus):
    staged = durable(c.history.select("enrollment_id", "dept_id", "term_id", "gpa_points"), "legs")
    return aggregates.fan_in({"by_dept": (aggregates.counts(staged, "dept_id"), "n"),
                              "by_term": (aggregates.counts(staged, "term_id"), "n")})


@query("X10", """SELECT student_id, first_name || ' ' || last_name AS full_name, CASE WHEN email IS NOT NULL THEN split_part(email, '@', 2) END AS email_domain,
    dept_id FROM student WHERE status = 'active'""", "student")
def x10_active_students(c: Campus):
    return c.student.filter(F.col("status") == "active").select(
        "student_id", text.display_name("first_name", "last_name").alias("full_name"), text.after("email", "@").alias("email_domain"), "dept_id")


# -- T: telemetry -----------------------------------------------------------------


#: (as of, days before): the whole of what the given logs and the given usage cover.
LOG_WINDOW, SPEND_WINDOW = ("2024-01-31", 30), ("2001-12-31", 2557)


def runs(c: Campus):
    return telemetry.run_history([
        telemetry.timeline_runs(c.job_periods, c.jobs, "job_id", "run_id", "Job", *LOG_WINDOW),
        telemetry.timeline_runs(c.pipeline_periods, c.pipelines, "pipeline_id", "update_id", "Pipeline", *SPEND_WINDOW),
        telemetry.statement_runs(c.query_history, *LOG_WINDOW)])


@query("T01 U01 W06 A14", "SELECT workload_type, name, run_id, start_time, end_time, raw_state, status, round(secs / 60.0::DOUBLE, 2) AS duration_min FROM runs", "runs")
def t01_run_history(c: Campus):
    return runs(c)


@query("T02", """SELECT count(*) AS total_runs, sum(CASE WHEN status = 'Succeeded' THEN 1 ELSE 0 END)::BIGINT AS succeeded,
    sum(CASE WHEN status = 'Failed' THEN 1 ELSE 0 END)::BIGINT AS failed,
    round(sum(CASE WHEN status = 'Succeeded' THEN 1 ELSE 0 END)::BIGINT * 100.0::DOUBLE / count(*), 1) AS success_pct FROM runs""", "runs")
def t02_run_kpis(c: Campus):
    return telemetry.run_kpis(runs(c))


@query("T03", "SELECT workload_type, status, count(*) AS n FROM runs GROUP BY 1, 2", "runs")
def t03_runs_by_type(c: Campus):
    return aggregates.counts(runs(c), "workload_type", "status")


TASK_SQL = """task AS (SELECT job_id, run_id, task_key, min(period_start) AS start_time, max(period_end) AS e, max(result_state) AS result_state
    FROM job_periods GROUP BY 1, 2, 3), done AS (SELECT name, run_id, task_key, result_state, start_time,
    round((epoch(date_trunc('second', e)) - epoch(date_trunc('second', start_time))) / 60.0::DOUBLE, 2) AS duration_min
    FROM task JOIN job_names USING (job_id) WHERE result_state IS NOT NULL)"""


@query("T04", f"WITH {TASK_SQL} SELECT * FROM done", "job_periods job_names")
def t04_task_detail(c: Campus):
    return telemetry.task_runs(c.job_periods, c.jobs, *LOG_WINDOW)


@query("T04", f"WITH {TASK_SQL} SELECT task_key, count(*) AS n, {avg_sql('duration_min', 2, 4)} AS avg_min FROM done GROUP BY 1", "job_periods job_names")
def t04_task_average(c: Campus):
    return telemetry.task_runs(c.job_periods, c.jobs, *LOG_WINDOW).groupBy("task_key").agg(
        F.count("*").alias("n"), values.exact_avg("duration_min", 2, 4).alias("avg_min"))


@query("T05 A10", """SELECT start_time::DATE AS query_date, warehouse_id, count(*) AS query_count, round(avg(total_duration_ms), 0) AS avg_ms,
    sum(CASE WHEN waiting_ms > 0 THEN 1 ELSE 0 END)::BIGINT AS throttled, round(avg(waiting_ms), 0) AS avg_queue_ms,
    round(quantile_cont(total_duration_ms, 0.95), 2) AS p95_ms FROM query_history GROUP BY 1, 2""", "query_history")
def t05_daily_capacity(c: Campus):
    return telemetry.daily_capacity(c.query_history, *LOG_WINDOW)


@query("T06", """SELECT date_trunc('hour', start_time) AS hour, warehouse_id, count(*) AS query_count, round(avg(total_duration_ms), 0) AS avg_ms,
    sum(CASE WHEN waiting_ms > 0 THEN 1 ELSE 0 END)::BIGINT AS throttled FROM query_history GROUP BY 1, 2""", "query_history")
def t06_hourly_utilisation(c: Campus):
    return telemetry.hourly_use(c.query_history, *LOG_WINDOW)


@query("T07", """SELECT executed_by AS user_name, count(*) AS query_count, round(avg(total_duration_ms), 0) AS avg_ms,
    sum(CASE WHEN waiting_ms > 0 THEN 1 ELSE 0 END)::BIGINT AS throttled, sum(read_rows)::BIGINT AS rows_read FROM query_history GROUP BY 1""", "query_history")
def t07_user_workload(c: Campus):
    return telemetry.user_load(c.query_history, *LOG_WINDOW)


@query("T07 P10", """SELECT executed_by AS user_name, count(*) AS query_count, round(avg(total_duration_ms), 0) AS avg_ms,
    sum(CASE WHEN waiting_ms > 0 THEN 1 ELSE 0 END)::BIGINT AS throttled, sum(read_rows)::BIGINT AS rows_read FROM query_history
    WHERE start_time >= DATE '2024-01-13' AND start_time < DATE '2024-01-21' GROUP BY 1""", "query_history")
def t07_week_workload(c: Campus):
    """One day and the seven before it."""
    return telemetry.user_load(c.query_history, "2024-01-20", 7)


@query("T08", f"SELECT {TIER} AS perf_tier, count(*) AS queries FROM query_history GROUP BY 1", "query_history")
def t08_tier_distribution(c: Campus):
    return telemetry.tiers(c.query_history, *LOG_WINDOW)


@query("T09", "SELECT workload_type, name, run_id, secs AS seconds FROM runs WHERE secs > 1800", "runs")
def t09_sla_breaches(c: Campus):
    return telemetry.breaches(runs(c), 1800).select("workload_type", "name", "run_id", "seconds")


SPEND = "round(sum(round(cost * 10000)::BIGINT)::DOUBLE / 10000, 2) AS est_usd, sum(quantity) AS units, sum(CASE WHEN price IS NULL THEN 1 ELSE 0 END)::BIGINT AS unpriced"


def costs(c: Campus):
    return cost.priced(c.usage, c.prices, *SPEND_WINDOW)


@query("T10 J07", f"SELECT product, {SPEND} FROM costs GROUP BY 1", "costs")
def t10_spend_by_product(c: Campus):
    return cost.spend(costs(c), "product")


@query("T10", f"SELECT usage_date, {SPEND} FROM costs GROUP BY 1", "costs")
def t10_spend_by_day(c: Campus):
    return cost.spend(costs(c), "usage_date")


@query("T10", f"SELECT sku_name, {SPEND} FROM costs GROUP BY 1", "costs")
def t10_spend_by_sku(c: Campus):
    return cost.spend(costs(c), "sku_name")


@query("T11", f"""SELECT CASE product WHEN 'PROMO' THEN 'storage' WHEN 'SMALL' THEN 'transfer' ELSE 'compute' END AS driver, {SPEND} FROM costs GROUP BY 1""", "costs")
def t11_cost_drivers(c: Campus):
    """Products are given the word that marks their kind, then classified by that word."""
    marked = F.when(F.col("product") == "PROMO", F.concat(F.lit("STORAGE_"), "product")).when(
        F.col("product") == "SMALL", F.concat("product", F.lit("_EGRESS"))).otherwise(F.col("product"))
    return cost.spend(costs(c).withColumn("driver", cost.cost_driver(marked)), "driver")


@query("T12 F12", """WITH t AS (SELECT c.cost, c_mktsegment AS seg, o_orderpriority AS pri FROM costs c JOIN orders ON order_id = o_orderkey
      JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus <> 'P')
    SELECT 'segment' AS tag_key, seg AS tag_value, round(sum(round(cost * 10000)::BIGINT)::DOUBLE / 10000, 2) AS est_usd FROM t GROUP BY 1, 2
    UNION ALL SELECT 'priority', pri, round(sum(round(cost * 10000)::BIGINT)::DOUBLE / 10000, 2) FROM t GROUP BY 1, 2""", "costs")
def t12_spend_by_tag(c: Campus):
    return cost.spend_by_tag(cost.priced(c.usage_tagged, c.prices, *SPEND_WINDOW))


@query("T12", """WITH t AS (SELECT c.cost, o_orderstatus AS st, c_mktsegment AS seg, o_orderpriority AS pri FROM costs c JOIN orders ON order_id = o_orderkey
      JOIN customer ON o_custkey = c_custkey),
    u AS (SELECT CASE WHEN st <> 'P' THEN 'segment' END AS tag_key, CASE WHEN st <> 'P' THEN seg END AS tag_value, cost FROM t
      UNION ALL SELECT 'priority', pri, cost FROM t WHERE st <> 'P')
    SELECT tag_key, tag_value, round(sum(round(cost * 10000)::BIGINT)::DOUBLE / 10000, 2) AS est_usd FROM u GROUP BY 1, 2""", "costs")
def t12_spend_by_tag_keep_untagged(c: Campus):
    return cost.spend_by_tag(cost.priced(c.usage_tagged, c.prices, *SPEND_WINDOW), keep_untagged=True)


@query("T13", """SELECT warehouse_id, count(*) AS event_count, max(cluster_count)::INTEGER AS max_clusters,
    sum(CASE WHEN event_type = 'SCALED_UP' THEN 1 ELSE 0 END)::BIGINT AS scale_ups FROM warehouse_events GROUP BY 1""", "warehouse_events")
def t13_scaling(c: Campus):
    return cost.scaling(c.warehouse_events)


@query("T13", """SELECT DISTINCT user_id FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE ts >= TIMESTAMP '2024-01-30 00:00:00')""")
def t13_idle(c: Campus):
    log = c.raw("events").select("user_id", F.col("ts").alias("event_time"))
    return cost.idle(log, log, "user_id", "2024-01-31", 1)


@query("T14", """WITH s AS (SELECT year(usage_date)::INTEGER AS year, sum(round(cost * 10000)::BIGINT)::DOUBLE / 10000 AS spend FROM costs GROUP BY 1)
    SELECT year, round(spend, 2) AS spend, 500000.0::DOUBLE AS budget, round(spend / 500000.0::DOUBLE * 100, 1) AS pct_of_budget,
    CASE WHEN spend / 500000.0::DOUBLE > 1.1 THEN 'OVER BUDGET' WHEN spend / 500000.0::DOUBLE > 0.9 THEN 'WARNING' ELSE 'OK' END AS budget_status FROM s""", "costs")
def t14_budget_status(c: Campus):
    spent = costs(c).groupBy(F.year("usage_date").alias("year")).agg(values.exact_total("cost", 4).alias("spend"))
    return cost.budget_status(spent, 500000).withColumn("spend", F.round("spend", 2))


@query("T15", """WITH m AS (SELECT sum(round(cost * 10000)::BIGINT)::DOUBLE / 10000 AS s FROM costs WHERE usage_date BETWEEN DATE '2000-06-01' AND DATE '2000-06-20')
    SELECT round(s, 2) AS spend_to_date, round(s / 20, 2) AS daily_burn, round(s / 20 * 30, 2) AS projected FROM m""", "costs")
def t15_month_end_projection(c: Campus):
    return cost.month_end(costs(c), "usage_date", "cost", "2000-06-20")


@query("T16", """WITH d AS (SELECT product, usage_date, sum(round(cost * 10000)::BIGINT)::DOUBLE / 10000 AS y, (usage_date - DATE '1970-01-01')::DOUBLE AS x FROM costs GROUP BY 1, 2, 4),
    f AS (SELECT product, regr_slope(y, x) AS m, regr_intercept(y, x) AS b, regr_syy(y, x) AS syy, regr_sxy(y, x) AS sxy, count(*) AS n, max(usage_date) AS l FROM d WHERE y IS NOT NULL GROUP BY 1),
    p AS (SELECT product, l + h::INTEGER AS day, b + m * (l + h::INTEGER - DATE '1970-01-01') AS v, sqrt(greatest(syy - m * sxy, 0) / (n - 2)) AS sd FROM f, (SELECT unnest(range(1, 31)) AS h))
    SELECT product, day, round(v, 2) AS forecast, round(v - 1.645::DOUBLE * sd, 2) AS low, round(v + 1.645::DOUBLE * sd, 2) AS high FROM p""", "costs")
def t16_spend_forecast(c: Campus):
    daily = (costs(c).groupBy("product", "usage_date").agg(values.exact_total("cost", 4).alias("usd"))
             .filter(F.col("usd").isNotNull()))
    return cost.forecast(daily, "product", "usage_date", "usd")


@query("T16", """WITH d AS (SELECT product, usage_date, sum(round(cost * 10000)::BIGINT)::DOUBLE / 10000 AS y, (usage_date - DATE '1970-01-01')::DOUBLE AS x FROM costs GROUP BY 1, 2, 4),
    w AS (SELECT product, isodow(usage_date) AS wd, count(*) AS n, avg(x) AS mx, avg(y) AS my, regr_sxx(y, x) AS sxx, regr_sxy(y, x) AS sxy, regr_syy(y, x) AS syy, max(usage_date) AS l
      FROM d WHERE y IS NOT NULL GROUP BY 1, 2),
    f AS (SELECT product, sum(sxy) / sum(sxx) AS m, sum(sxx) AS sxx, sum(syy) - sum(sxy) ^ 2 / sum(sxx) AS rest, sum(n) - count(*) - 1 AS df, max(l) AS l FROM w GROUP BY 1),
    p AS (SELECT product, l + h::INTEGER AS day FROM f, (SELECT unnest(range(1, 31)) AS h)),
    v AS (SELECT p.product, day, my + m * (day - DATE '1970-01-01' - mx) AS v, sqrt(greatest(rest, 0) / df * (1 + 1.0::DOUBLE / n + (day - DATE '1970-01-01' - mx) ^ 2 / f.sxx)) AS sd, df
      FROM p JOIN f USING (product) LEFT JOIN w ON w.product = p.product AND wd = isodow(day)),
    q AS (SELECT *, 1.645::DOUBLE AS z FROM v), t AS (SELECT *, z + (z ^ 3 + z) / 4 / df + (5 * z ^ 5 + 16 * z ^ 3 + 3 * z) / 96 / df ^ 2 + (3 * z ^ 7 + 19 * z ^ 5 + 17 * z ^ 3 - 15 * z) / 384 / df ^ 3 AS t FROM q)
    SELECT product, day, round(v, 2) AS forecast, round(v - t * sd, 2) AS low, round(v + t * sd, 2) AS high FROM t""", "costs")
def t16_weekday_forecast(c: Campus):
    """Trend and weekday effects with a band that widens with the horizon."""
    daily = (costs(c).groupBy("product", "usage_date").agg(values.exact_total("cost", 4).alias("usd"))
             .filter(F.col("usd").isNotNull()))
    return cost.weekday_forecast(daily, "product", "usage_date", "usd")


@query("T17", f"""WITH t AS (SELECT sum(round(cost * 10000)::BIGINT)::DOUBLE / 10000 AS t FROM costs), w AS (SELECT d.name AS department,
      count(*)::DOUBLE / (SELECT count(*) FROM student) AS weight FROM student JOIN department d USING (dept_id) GROUP BY 1)
    SELECT department, weight, round(weight * (SELECT t FROM t), 2) AS allocated_usd FROM w""", "costs student department")
def t17_chargeback(c: Campus):
    """Total spend split by each department's share of students."""
    everyone = c.student.agg(F.count("*")).scalar()
    heads = c.student.groupBy("dept_id").agg(F.count("*").alias("n")).join(c.department, "dept_id")
    weights = heads.select(F.col("name").alias("department"), (F.col("n") / everyone).alias("weight"))
    return cost.chargeback(weights, costs(c), "cost")


@query("T18", """SELECT statement_id, total_duration_ms, read_rows, round(total_duration_ms / 3600000.0::DOUBLE * 0.4::DOUBLE, 6) AS cost_small,
    round(total_duration_ms / 3600000.0::DOUBLE * 1.2::DOUBLE, 6) AS cost_medium,
    round(total_duration_ms / 3600000.0::DOUBLE * 0.4::DOUBLE / read_rows, 9) AS cost_per_row FROM query_history WHERE read_rows > 0""", "query_history")
def t18_cost_per_query(c: Campus):
    return telemetry.query_costs(c.query_history, *LOG_WINDOW, {"small": 0.4, "medium": 1.2})


@query("T18", """SELECT executed_by AS user_name, count(DISTINCT statement_id) AS query_count, round(avg(total_duration_ms), 2) AS avg_ms,
    round(sum(total_duration_ms)::BIGINT / 3600000.0::DOUBLE * 0.4::DOUBLE, 4) AS estimated_cost FROM query_history GROUP BY 1""", "query_history")
def t18_cost_per_user(c: Campus):
    return telemetry.user_costs(c.query_history, *LOG_WINDOW, 0.4)


@query("T18 L01", """SELECT statement_id, executed_by AS user_name, total_duration_ms, substr(statement_text, 1, 100) AS snippet,
    round(total_duration_ms / 3600000.0::DOUBLE * 1.2::DOUBLE, 4) AS query_cost FROM query_history WHERE total_duration_ms > 5000
    ORDER BY total_duration_ms DESC, statement_id LIMIT 20""", "query_history")
def t18_slow_queries(c: Campus):
    return telemetry.slow_queries(c.query_history, *LOG_WINDOW, 5000, 1.2, 20)


@query("T18 P06", f"""SELECT {BUCKET} AS bucket, count(*) AS query_count, round(avg(read_rows), 2) AS avg_rows,
    round(avg(total_duration_ms), 2) AS avg_ms FROM query_history GROUP BY 1""", "query_history")
def t18_latency_histogram(c: Campus):
    return telemetry.latency_histogram(c.query_history, *LOG_WINDOW)


@query("T20 A20", """WITH s AS (SELECT product, round(sum(round(cost * 10000)::BIGINT)::DOUBLE / 10000, 2) AS est_usd, sum(quantity) AS units FROM costs GROUP BY 1)
    SELECT product, est_usd, units, round(est_usd * 100.0::DOUBLE / sum(est_usd) OVER (), 1) AS pct_of_total FROM s""", "costs")
def t20_service_shares(c: Campus):
    return cost.service_shares(costs(c), "product")


@query("T20", """SELECT date_trunc('month', usage_date)::DATE AS month, round(sum(round(cost * 10000)::BIGINT)::DOUBLE / 10000, 2) AS monthly_usd,
    count(DISTINCT usage_date) AS days_active FROM costs GROUP BY 1""", "costs")
def t20_monthly_spend(c: Campus):
    return cost.monthly(costs(c), "usage_date")


@query("T21", "SELECT statement_id, executed_by, execution_status, total_duration_ms, read_rows FROM query_history WHERE statement_text ILIKE '%purchase_log%'", "query_history")
def t21_statement_filter(c: Campus):
    return telemetry.statements_like(c.query_history, *LOG_WINDOW, "%purchase_log%")


@query("T22", """WITH d AS (SELECT start_time::DATE AS query_date, warehouse_id, count(*) AS volume,
      sum(CASE WHEN total_duration_ms > 4000 THEN 1 ELSE 0 END)::BIGINT AS slow FROM query_history GROUP BY 1, 2)
    SELECT query_date, warehouse_id, 'slow_queries' AS alert, slow AS value FROM d WHERE slow > 2
    UNION ALL SELECT query_date, warehouse_id, 'query_volume', volume FROM d WHERE volume > 70""", "query_history")
def t22_daily_alerts(c: Campus):
    return telemetry.alerts(c.query_history, *LOG_WINDOW, 4000, 2, 70)


@query("T22", """WITH w AS (SELECT date_trunc('week', start_time)::DATE AS week, warehouse_id, count(DISTINCT date_trunc('hour', start_time)) AS busy_hours
      FROM query_history GROUP BY 1, 2), ids AS (SELECT DISTINCT warehouse_id FROM query_history),
    weeks AS (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2024-01-29', INTERVAL 7 DAY))::DATE AS week),
    a AS (SELECT weeks.week, ids.warehouse_id, coalesce(busy_hours, 0) AS busy_hours FROM ids CROSS JOIN weeks LEFT JOIN w ON w.week = weeks.week AND w.warehouse_id = ids.warehouse_id)
    SELECT week, warehouse_id, busy_hours, round(1 - busy_hours / 168.0::DOUBLE, 4) AS idle_share FROM a
    WHERE round(1 - busy_hours / 168.0::DOUBLE, 4) > 0.02""", "query_history")
def t22_idle_alerts(c: Campus):
    return telemetry.idle_share(c.query_history, *LOG_WINDOW, c.query_history.select("compute.warehouse_id"), 0.02)


@query("T22 T14", """SELECT date_trunc('month', usage_date)::DATE AS month, round(sum(round(cost * 10000)::BIGINT)::DOUBLE / 10000, 2) AS monthly_usd
    FROM costs GROUP BY 1 HAVING sum(round(cost * 10000)::BIGINT)::DOUBLE / 10000 > 1.1 * 40000""", "costs")
def t22_overspend_alerts(c: Campus):
    return cost.monthly(costs(c), "usage_date").filter(F.col("monthly_usd") > 1.1 * 40000).select("month", "monthly_usd")
