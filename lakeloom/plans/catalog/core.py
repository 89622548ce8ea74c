"""Projections, joins, aggregates, windows, limits, sets and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.functions import dates, text, values
from lakeloom.operators import aggregates, joins, ordered, quality, windows
from lakeloom.operators.sizing import checked_broadcast
from lakeloom.operators.telemetry import tier
from lakeloom.plans.campus import GRADES, Campus
from lakeloom.plans.oracle import STANDING, TIER, case_band, list_of
from lakeloom.plans.registry import query
from lakeloom.session import durable

AVG = "round(sum(round({x} * {m})::BIGINT)::DOUBLE / count({x}) / {m}::DOUBLE, {d})"


def avg_sql(x: str, scale: int, digits: int) -> str:
    return AVG.format(x=x, m=10**scale, d=digits)


GPA4 = avg_sql("gpa_points", 1, 4)

# -- P: projections, filters, predicates ---------------------------------


@query("P01", "SELECT enrollment_id AS id, student_id, gpa_points * 25 AS pct, grade AS letter FROM enrollment",
       "enrollment")
def p01_rename_derive_drop(c: Campus):
    return (c.enrollment.select("enrollment_id", "student_id", "course_id", "grade", "gpa_points")
            .withColumnsRenamed({"enrollment_id": "id", "grade": "letter"})
            .withColumns({"pct": F.col("gpa_points") * 25}).drop("course_id", "gpa_points"))


@query("P02", "SELECT student_id, status FROM student WHERE status = 'active'", "student")
def p02_parameter_filter(c: Campus):
    return c.spark.sql("SELECT student_id, status FROM {student} WHERE status = :wanted",
                       args={"wanted": "active"}, student=c.student)


@query("P03", "SELECT enrollment_id, dept_id, term_id FROM history WHERE dept_id = 5", "history")
def p03_optional_filters(c: Campus):
    dept, term = 5, None
    wanted = values.all_of([F.col("dept_id") == dept if dept is not None else None,
                            F.col("term_id") == term if term is not None else None])
    return c.history.filter(wanted).select("enrollment_id", "dept_id", "term_id")


@query("P04", f"SELECT student_id, {STANDING} AS standing FROM student", "student")
def p04_standing(c: Campus):
    return c.student.select("student_id", values.standing("status").alias("standing"))


BAND_SQL = f"""SELECT {case_band('gpa_points')} AS band, {case_band('gpa_points', order=True)} AS band_order,
    count(*) AS enrollments FROM history GROUP BY ALL"""


@query("P05", BAND_SQL, "history")
def p05_point_bands(c: Campus):
    band, order = values.bands("gpa_points")
    return c.history.groupBy(band.alias("band"), order.alias("band_order")).agg(F.count("*").alias("enrollments"))


@query("P06", f"SELECT statement_id, {TIER} AS perf_tier, CASE WHEN waiting_ms > 0 THEN 1 ELSE 0 END AS was_throttled FROM query_history",
       "query_history")
def p06_performance_tier(c: Campus):
    return c.query_history.select("statement_id", tier("total_duration_ms").alias("perf_tier"),
                                  values.throttled("waiting_ms").alias("was_throttled"))


@query("P07", """SELECT enrollment_id, grade, CASE WHEN status IN ('active','graduated','withdrawn') THEN status
    ELSE 'unknown' END AS status_normalized FROM enrollment JOIN student USING (student_id)
    WHERE grade IN ('C', 'C+')""", "enrollment student")
def p07_membership(c: Campus):
    return (c.enrollment.filter(F.col("grade").isin("C", "C+")).join(c.student, "student_id")
            .select("enrollment_id", "grade",
                    values.allowed_or("status", ["active", "graduated", "withdrawn"]).alias("status_normalized")))


@query("P08", """SELECT c_custkey, c_name LIKE 'Customer#00000%' AS starts, c_mktsegment ILIKE 'build%' AS building,
    regexp_matches(c_name, '[05]$') AS ends, lower(c_mktsegment) LIKE '%ch%' AS has_ch FROM customer""")
def p08_patterns(c: Campus):
    return c.raw("customer").select(
        "c_custkey", F.col("c_name").like("Customer#00000%").alias("starts"),
        F.col("c_mktsegment").ilike("build%").alias("building"), F.col("c_name").rlike("[05]$").alias("ends"),
        F.lower("c_mktsegment").like("%ch%").alias("has_ch"))


@query("P09", "SELECT student_id, email IS NULL AS email_was_null FROM student WHERE dob IS NOT NULL", "student")
def p09_null_flags(c: Campus):
    return c.student.filter(F.col("dob").isNotNull()).select(
        "student_id", F.col("email").isNull().alias("email_was_null"))


@query("P10", """SELECT event_date, count(*) AS n FROM audit
    WHERE event_date BETWEEN DATE '2024-01-24' AND DATE '2024-01-31' GROUP BY 1""", "audit")
def p10_rolling_window(c: Campus):
    from lakeloom.operators.governance import audit_window

    return audit_window(c.audit, "2024-01-31", 7).groupBy("event_date").agg(F.count("*").alias("n"))


STAGED_SQL = """staged AS (SELECT enrollment_id, CASE WHEN enrollment_id % 500 = 0 THEN 'N/A'
    ELSE gpa_points::VARCHAR END AS gpa_raw, TRY_CAST(CASE WHEN enrollment_id % 500 = 0 THEN 'N/A'
    ELSE gpa_points::VARCHAR END AS DOUBLE) AS gpa_typed FROM enrollment)"""


def staged_casts(c: Campus):
    from lakeloom.sources.generate import plant

    raw = c.enrollment.select("enrollment_id", F.col("gpa_points").cast("string").alias("gpa_raw"))
    planted = plant(raw, "enrollment_id", {"gpa_raw": (500, F.lit("N/A"))})
    return planted.withColumn("gpa_typed", F.col("gpa_raw").try_cast("double"))


@query("P11 F10", f"WITH {STAGED_SQL} SELECT * FROM staged", "enrollment")
def p11_planted_casts(c: Campus):
    return staged_casts(c)


@query("P12", """SELECT o_orderkey, concat_ws('+', CASE WHEN o_orderstatus = 'F' THEN 'file' END,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'db' END, 'api') AS source_system FROM orders""")
def p12_provenance(c: Campus):
    return c.raw("orders").select("o_orderkey", F.concat_ws(
        "+", F.when(F.col("o_orderstatus") == "F", "file"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "db"), F.lit("api")).alias("source_system"))


# -- J: joins ---------------------------------------------------------------


def star(c: Campus):
    """Enrolment with course, department (of the course) and term."""
    return joins.star(c.enrollment, [
        (c.course.select("course_id", "dept_id"), "course_id"),
        (c.department.select("dept_id", F.col("name").alias("department")), "dept_id"),
        (c.term.select("term_id", "year", "season"), "term_id")])


STAR_SQL = """star AS (SELECT e.*, c.dept_id, d.name AS department, t.year, t.season FROM enrollment e
    JOIN course c USING (course_id) JOIN department d ON c.dept_id = d.dept_id JOIN term t ON e.term_id = t.term_id)"""
STAR_NEEDS = "enrollment course department term"


@query("J01", f"WITH {STAR_SQL} SELECT enrollment_id, student_id, department, year, season, grade FROM star", STAR_NEEDS)
def j01_star_join(c: Campus):
    return star(c).select("enrollment_id", "student_id", "department", "year", "season", "grade")


@query("J02", """SELECT student_id, d.name AS dept_name, CASE WHEN d.name IS NOT NULL THEN 'matched' ELSE 'UNMATCHED' END
    AS match_status FROM student LEFT JOIN (SELECT * FROM department WHERE division <> 'ASIA') d USING (dept_id)""",
       "student department")
def j02_lookup_enrichment(c: Campus):
    lookup = c.department.filter(F.col("division") != "ASIA").select("dept_id", F.col("name").alias("dept_name"))
    return joins.enrich(c.student, lookup, "dept_id", "dept_name").select("student_id", "dept_name", "match_status")


@query("J03", """WITH a AS (SELECT student_id FROM student WHERE status = 'active'),
    f AS (SELECT student_id FROM aid WHERE amount > 200000)
    SELECT 'inner' AS join_type, (SELECT count(*) FROM a JOIN f USING (student_id)) AS row_count
    UNION ALL SELECT 'left', (SELECT count(*) FROM a LEFT JOIN f USING (student_id))
    UNION ALL SELECT 'full', (SELECT count(*) FROM a FULL JOIN f USING (student_id))""", "student aid")
def j03_join_cardinalities(c: Campus):
    return joins.join_counts(c.student.filter(F.col("status") == "active").select("student_id"),
                             c.aid.filter(F.col("amount") > 200000).select("student_id"), "student_id")


@query("J04", "SELECT enrollment_id, name AS department FROM history JOIN department USING (dept_id)", "history department")
def j04_broadcast_dimension(c: Campus):
    dim = checked_broadcast(c.department.select("dept_id", F.col("name").alias("department")))
    return c.history.join(dim, "dept_id").select("enrollment_id", "department")


@query("J05", """SELECT f.faculty_id, f.name, d.name AS dept_name, count(DISTINCT c.course_id) AS courses_taught,
    count(DISTINCT h.student_id) AS students_enrolled FROM faculty f JOIN department d ON f.dept_id = d.dept_id
    LEFT JOIN course c ON f.faculty_id = c.faculty_id AND c.title LIKE '%ring%'
    LEFT JOIN history h ON c.course_id = h.course_id GROUP BY ALL""", "faculty department course history")
def j05_two_child_levels(c: Campus):
    """Children are reduced to one row per teacher before any join, so parents never multiply."""
    course = c.course.filter(F.col("title").like("%ring%")).select("course_id", "faculty_id")
    taught = course.groupBy("faculty_id").agg(F.countDistinct("course_id").alias("courses_taught"))
    seen = (c.history.select("course_id", "student_id").join(course, "course_id")
            .groupBy("faculty_id").agg(F.countDistinct("student_id").alias("students_enrolled")))
    dept = c.department.select("dept_id", F.col("name").alias("dept_name"))
    return (c.faculty.select("faculty_id", "name", "dept_id").join(dept, "dept_id")
            .join(taught, "faculty_id", "left").join(seen, "faculty_id", "left").drop("dept_id")
            .na.fill(0, subset=["courses_taught", "students_enrolled"]))


def ranking_upload(c: Campus):
    """An outside ranking by department: half of them, and one key nobody has."""
    known = c.department.filter(F.col("division") != "EUROPE").select(
        "dept_id", (F.col("dept_id") + 1).cast("int").alias("external_rank"))
    return known.unionByName(c.spark.createDataFrame([(999, 999)], "dept_id long, external_rank int"))


UPLOAD_SQL = """up AS (SELECT dept_id, (dept_id + 1)::INTEGER AS external_rank FROM department WHERE division <> 'EUROPE'
    UNION ALL SELECT 999, 999)"""


@query("J06", f"WITH {UPLOAD_SQL} SELECT student_id, dept_id, external_rank FROM student LEFT JOIN up USING (dept_id)",
       "student department")
def j06_blend_upload(c: Campus):
    joined, _ = joins.blend(c.student.select("student_id", "dept_id"), ranking_upload(c), "dept_id", "external_rank")
    return joined


@query("J06 Q04", f"""WITH {UPLOAD_SQL}, j AS (SELECT * FROM student LEFT JOIN up USING (dept_id))
    SELECT 'rows_before' AS gate, (SELECT count(*) FROM student) AS value
    UNION ALL SELECT 'rows_after', (SELECT count(*) FROM j)
    UNION ALL SELECT 'matched', (SELECT count(external_rank) FROM j)
    UNION ALL SELECT 'unmatched', (SELECT count(*) - count(external_rank) FROM j)
    UNION ALL SELECT 'repeated_keys', (SELECT count(*) - count(DISTINCT dept_id) FROM up)
    UNION ALL SELECT 'stale_keys', (SELECT count(*) FROM up WHERE dept_id NOT IN (SELECT dept_id FROM student))""",
       "student department")
def q04_join_cardinality_gates(c: Campus):
    _, gates = joins.blend(c.student.select("student_id", "dept_id"), ranking_upload(c), "dept_id", "external_rank")
    return gates


@query("J07", "SELECT sku_name, usage_end, quantity, price FROM costs", "costs")
def j07_temporal_price_join(c: Campus):
    return joins.interval_join(c.usage, c.prices, "sku_name", "usage_end", "price_start", "price_end").select(
        "sku_name", "usage_end", "quantity", "price")


@query("J07", "SELECT sku_name, usage_end, quantity, price FROM costs", "costs")
def j07_temporal_price_join_by_month(c: Campus):
    """The join for windows that may overlap, on its path for tables too large to broadcast."""
    return joins.temporal_join(c.usage, c.prices, "sku_name", "usage_end", "price_start", "price_end",
                               small=False).select("sku_name", "usage_end", "quantity", "price")


@query("J08", """SELECT student_id, dept_id FROM student WHERE dept_id IN
    (SELECT dept_id FROM access WHERE principal = 'division:ASIA')""", "student access")
def j08_semi_join(c: Campus):
    mapped = c.access.filter(F.col("principal") == "division:ASIA").select("dept_id")
    return c.student.select("student_id", "dept_id").join(mapped, "dept_id", "left_semi")


@query("J09", "SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def j09_anti_join(c: Campus):
    lines = c.raw("lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return c.raw("orders").select("o_orderkey").join(lines, "o_orderkey", "left_anti")


@query("J10", """WITH n AS (SELECT dept_id, count(DISTINCT student_id) AS students FROM history GROUP BY 1)
    SELECT enrollment_id, student_id, dept_id, students FROM history JOIN n USING (dept_id)""", "history")
def j10_aggregate_join_back(c: Campus):
    rows = c.history.select("enrollment_id", "student_id", "dept_id")
    return joins.aggregate_and_join_back(rows, ["dept_id"], students=F.countDistinct("student_id"))


@query("J11 X08", """WITH files AS (SELECT student_id, first_name, last_name, dept_id FROM student WHERE status <> 'withdrawn'),
    db AS (SELECT student_id, status FROM student WHERE status <> 'leave')
    SELECT e.enrollment_id, e.student_id, e.course_id, e.term_id, e.gpa_points, f.first_name, f.last_name, f.dept_id, CASE WHEN f.student_id IS NOT NULL THEN d.status END AS status,
      e.grade, concat_ws('+', CASE WHEN f.student_id IS NOT NULL THEN 'file' END,
        CASE WHEN f.student_id IS NOT NULL AND d.student_id IS NOT NULL THEN 'db' END, 'api') AS source_system
    FROM enrollment e LEFT JOIN files f USING (student_id) LEFT JOIN db d ON d.student_id = e.student_id""",
       "enrollment student")
def x08_multisource_reconciliation(c: Campus):
    files = c.student.filter(F.col("status") != "withdrawn").select("student_id", "first_name", "last_name", "dept_id")
    db = c.student.filter(F.col("status") != "leave").select("student_id", "status")
    api = c.enrollment.select("enrollment_id", "student_id", "course_id", "term_id", "grade", "gpa_points")
    return joins.reconcile(api, [(files, "file"), (db, "db")], "student_id", "api")


@query("J12", """SELECT 'matched' AS side, count(*) AS n FROM enrollment JOIN (SELECT student_id FROM student WHERE status = 'active') USING (student_id)
    UNION ALL SELECT 'left only', count(*) FROM enrollment WHERE student_id NOT IN (SELECT student_id FROM student WHERE status = 'active')
    UNION ALL SELECT 'right only', count(*) FROM student WHERE status = 'active' AND student_id NOT IN (SELECT student_id FROM enrollment)""",
       "enrollment student")
def j12_split_join(c: Campus):
    active = c.student.filter(F.col("status") == "active").select("student_id")
    parts = joins.split_join(c.enrollment.select("student_id"), active, "student_id")
    return aggregates.labelled({label: df.agg(F.count("*").alias("n")) for label, df in
                                zip(["matched", "left only", "right only"], parts)}, "side")


@query("J13", """WITH u AS (SELECT student_id, first_name, dept_id, NULL AS status, 0 AS p FROM student WHERE status = 'active'
      UNION ALL SELECT student_id, upper(first_name), dept_id, status, 1 FROM student),
    s AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY student_id ORDER BY p) = 1)
    SELECT s.student_id, first_name, dept_id, status, enrollment_id, 'multi-source' AS source_system
    FROM s LEFT JOIN enrollment e ON s.student_id = e.student_id""", "student enrollment")
def j13_union_dedupe_join(c: Campus):
    files = c.student.filter(F.col("status") == "active").select("student_id", "first_name", "dept_id")
    db = c.student.select("student_id", F.upper("first_name").alias("first_name"), "dept_id", "status")
    people = joins.union_by_priority([files, db], "student_id")
    return people.join(c.enrollment.select("enrollment_id", "student_id"), "student_id", "left").withColumn(
        "source_system", F.lit("multi-source"))


@query("J15", """SELECT 'Teaching' AS department, 0.5::DOUBLE AS weight, round(0.5 * t, 2) AS allocated_usd FROM (SELECT round(sum(round(cost * 10000)::BIGINT)::DOUBLE / 10000, 4) AS t FROM costs)
    UNION ALL SELECT 'Research', 0.3::DOUBLE, round(0.3::DOUBLE * t, 2) FROM (SELECT sum(round(cost * 10000)::BIGINT)::DOUBLE / 10000 AS t FROM costs)
    UNION ALL SELECT 'Services', 0.2::DOUBLE, round(0.2::DOUBLE * t, 2) FROM (SELECT sum(round(cost * 10000)::BIGINT)::DOUBLE / 10000 AS t FROM costs)""", "costs")
def j15_scalar_allocation(c: Campus):
    from lakeloom.operators.cost import chargeback, priced

    weights = c.spark.createDataFrame([("Teaching", 0.5), ("Research", 0.3), ("Services", 0.2)],
                                      "department string, weight double")
    return chargeback(weights, priced(c.usage, c.prices, "2001-12-31", 2557), "cost")


@query("J16", """SELECT e.enrollment_id, c.dept_id AS course_dept, b.dept_name, b.budget_amount FROM enrollment e
    JOIN course c USING (course_id) JOIN budget b ON c.dept_id = b.dept_id""", "enrollment course budget")
def j16_ambiguous_keys(c: Campus):
    e, k, b = c.enrollment.alias("e"), c.course.alias("c"), c.budget.alias("b")
    return (e.join(k, F.col("e.course_id") == F.col("c.course_id")).join(b, F.col("c.dept_id") == F.col("b.dept_id"))
            .select("e.enrollment_id", F.col("c.dept_id").alias("course_dept"), "b.dept_name", "b.budget_amount"))


# -- A: aggregates ------------------------------------------------------------


@query("A01", "SELECT term_id, count(*) AS n FROM history GROUP BY 1", "history")
def a01_count_per_term(c: Campus):
    return aggregates.counts(c.history, "term_id")


@query("A02", """WITH a AS (SELECT term_id, count(*) AS n FROM history GROUP BY 1),
    b AS (SELECT dept_id, count(*) AS n FROM history GROUP BY 1)
    SELECT 'term' AS leg, count(*) AS n_groups, sum(n)::BIGINT AS total, true AS agree FROM a
    UNION ALL SELECT 'dept', count(*), sum(n)::BIGINT, true FROM b""", "history")
def a02_fan_in(c: Campus):
    return aggregates.fan_in({"term": (aggregates.counts(c.history, "term_id"), "n"),
                              "dept": (aggregates.counts(c.history, "dept_id"), "n")})


@query("A03", f"""SELECT dept_id, term_id, count(*) AS enrollments, {GPA4} AS avg_gpa,
    count(DISTINCT student_id) AS distinct_students FROM history GROUP BY 1, 2""", "history")
def a03_multi_measure(c: Campus):
    return c.history.groupBy("dept_id", "term_id").agg(
        F.count("*").alias("enrollments"), values.exact_avg("gpa_points", 1, 4).alias("avg_gpa"),
        F.countDistinct("student_id").alias("distinct_students"))


@query("A04", """WITH s AS (SELECT student_id, term_id, round(avg(gpa_points), 6) AS g FROM history
      WHERE gpa_points IS NOT NULL GROUP BY 1, 2)
    SELECT t.term_id, t.year, t.season, count(DISTINCT student_id) AS students, round(avg(g), 3) AS cohort_avg
    FROM s JOIN term t USING (term_id) GROUP BY ALL""", "history term")
def a04_average_of_averages(c: Campus):
    cohort = aggregates.stepped_average(c.history, ["student_id", "term_id"], ["term_id"], "gpa_points", "student_id")
    return cohort.join(c.term.select("term_id", "year", "season"), "term_id")


@query("A05", """SELECT student_id, count(*) AS n, sum(CASE WHEN grade = 'F' THEN 1 ELSE 0 END)::BIGINT AS failures,
    sum(CASE WHEN gpa_points IS NULL THEN 1 ELSE 0 END)::BIGINT AS withdrawals FROM enrollment GROUP BY 1""", "enrollment")
def a05_conditional_counts(c: Campus):
    return aggregates.conditional_counts(c.enrollment, ["student_id"], failures=F.col("grade") == "F",
                                         withdrawals=F.col("gpa_points").isNull())


@query("A06", f"""WITH {STAR_SQL} SELECT count(enrollment_id) AS total_enrollments, count(DISTINCT student_id) AS students,
    count(DISTINCT dept_id) AS departments, {GPA4} AS avg_gpa,
    round(100.0::DOUBLE * sum(CASE WHEN grade = 'W' THEN 1 ELSE 0 END)::BIGINT / count(*), 4) AS withdrawn_pct FROM star""", STAR_NEEDS)
def a06_global_kpis(c: Campus):
    return star(c).agg(
        F.count("enrollment_id").alias("total_enrollments"), F.countDistinct("student_id").alias("students"),
        F.countDistinct("dept_id").alias("departments"), values.exact_avg("gpa_points", 1, 4).alias("avg_gpa"),
        F.round(F.lit(100.0) * F.sum(F.when(F.col("grade") == "W", 1).otherwise(0)) / F.count("*"), 4).alias("withdrawn_pct"))


@query("A07", f"""SELECT student_id, 0::INTEGER AS part, count(*) AS courses_taken, {avg_sql('gpa_points', 1, 3)} AS avg_gpa,
    array_to_string(list_sort(list(grade) FILTER (grade IS NOT NULL)), ',') AS grade_history, sum(CASE WHEN grade = 'F' THEN 1 ELSE 0 END)::BIGINT AS failures
    FROM enrollment GROUP BY 1""", "enrollment")
def a07_student_summary(c: Campus):
    base = c.enrollment.groupBy("student_id").agg(
        F.count("*").alias("courses_taken"), values.exact_avg("gpa_points", 1, 3).alias("avg_gpa"),
        F.sum(F.when(F.col("grade") == "F", 1).otherwise(0)).alias("failures"))
    grades = ordered.list_values(c.enrollment, ["student_id"], "grade", "grade_history")
    listed = grades.withColumn("grade_history", F.array_join("grade_history", ","))
    return base.join(listed, "student_id", "left").withColumn("part", F.coalesce("part", F.lit(0)))


@query("A08 F11", """SELECT dept_id, 0::INTEGER AS part, count(*)::INTEGER AS n_courses,
    to_json(list({'course_id': course_id, 'title': title, 'credits': credits} ORDER BY course_id))::VARCHAR AS courses
    FROM course GROUP BY 1""", "course")
def a08_nested_catalog(c: Campus):
    nested = ordered.nest_rows(c.course, ["dept_id"], [F.col("course_id")], ["course_id", "title", "credits"], "courses")
    return nested.select("dept_id", "part", F.size("courses").alias("n_courses"), F.to_json("courses").alias("courses"))


@query("A09", "SELECT dept_id, quantile_disc(gpa_points, 0.5) AS median_gpa FROM history GROUP BY 1", "history")
def a09_approximate_median(c: Campus):
    """A mergeable sketch that returns a value that occurs; with ten distinct values it is the exact one."""
    return c.history.groupBy("dept_id").agg(F.approx_percentile("gpa_points", 0.5).alias("median_gpa"))


@query("A10", """SELECT dept_id, round(quantile_cont(amount, 0.5), 4) AS median, round(quantile_cont(amount, 0.95), 4) AS p95
    FROM aid JOIN student USING (student_id) GROUP BY 1""", "aid student")
def a10_exact_percentiles(c: Campus):
    rows = c.aid.join(c.student.select("student_id", "dept_id"), "student_id")
    exact = ordered.exact_percentiles(rows, ["dept_id"], "amount", {"median": 0.5, "p95": 0.95})
    return exact.select("dept_id", F.round("median", 4).alias("median"), F.round("p95", 4).alias("p95"))


@query("A11", """SELECT count(gpa_points) AS n, round(avg(gpa_points), 4) AS mean, round(stddev_samp(gpa_points), 4) AS sd,
    min(gpa_points) AS min, max(gpa_points) AS max, round(quantile_cont(gpa_points, 0.25), 4) AS q1,
    round(quantile_cont(gpa_points, 0.5), 4) AS median, round(quantile_cont(gpa_points, 0.75), 4) AS q3 FROM history""", "history")
def a11_summary_statistics(c: Campus):
    return aggregates.summary(c.history, [], "gpa_points")


@query("A12", "SELECT grade, count(*) AS n FROM history GROUP BY 1", "history")
def a12_frequency(c: Campus):
    return aggregates.counts(c.history, "grade")


@query("A13", """SELECT l_suppkey AS who, l_returnflag AS what, count(*) AS n, min(l_shipdate) AS first_seen,
    max(l_shipdate) AS last_seen FROM lineitem GROUP BY 1, 2""")
def a13_first_last(c: Campus):
    return c.raw("lineitem").groupBy(F.col("l_suppkey").alias("who"), F.col("l_returnflag").alias("what")).agg(
        F.count("*").alias("n"), F.min("l_shipdate").alias("first_seen"), F.max("l_shipdate").alias("last_seen"))


@query("A14", """SELECT job_id, run_id, min(period_start) AS start_time, max(period_end) AS end_time,
    max(result_state) AS raw_state FROM job_periods GROUP BY 1, 2""", "job_periods")
def a14_timeline_collapse(c: Campus):
    return aggregates.collapse_timeline(c.job_periods, ["job_id", "run_id"], "period_start", "period_end", "result_state")


@query("A15", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING n > 1")
def a15_having_duplicates(c: Campus):
    return aggregates.having(c.raw("lineitem"), ["l_orderkey", "l_linenumber"])


@query("A16", "SELECT year(o_orderdate)::INTEGER AS y, o_orderstatus AS st, count(*) AS n FROM orders GROUP BY 1, 2")
def a16_ordinal_and_alias_grouping(c: Campus):
    return c.spark.sql("SELECT year(o_orderdate) AS y, o_orderstatus AS st, count(*) AS n FROM {o} GROUP BY 1, st",
                       o=c.raw("orders"))


PIVOT_SQL = ", ".join(f"count(*) FILTER (grade = '{g}') AS \"{g}\"" for g in GRADES)


@query("A17", f"SELECT dept_id, {PIVOT_SQL} FROM history GROUP BY 1", "history")
def a17_grade_pivot(c: Campus):
    return aggregates.pivot_counts(c.history, "dept_id", "grade", GRADES)


@query("A18", f"""SELECT dept_id, g AS grade, (SELECT count(*) FROM history h WHERE h.dept_id = d.dept_id AND h.grade = g) AS cnt
    FROM (SELECT DISTINCT dept_id FROM history) d, (SELECT unnest({list_of(GRADES)}) AS g)""", "history")
def a18_unpivot(c: Campus):
    wide = aggregates.pivot_counts(c.history, "dept_id", "grade", GRADES)
    return aggregates.unpivot_counts(wide, "dept_id", "grade", "cnt")


@query("A19", f"""SELECT course_id, {GPA4} AS avg_gpa, count(enrollment_id) AS enrollment_count,
    round(sum(CASE WHEN grade <> 'F' THEN 1 ELSE 0 END)::DOUBLE / count(enrollment_id), 6) AS pass_rate FROM enrollment GROUP BY 1""", "enrollment")
def a19_pass_rate(c: Campus):
    passed = F.sum(F.when(F.col("grade") != "F", 1).otherwise(0))
    return c.enrollment.groupBy("course_id").agg(
        values.exact_avg("gpa_points", 1, 4).alias("avg_gpa"), F.count("enrollment_id").alias("enrollment_count"),
        F.round(passed / F.count("enrollment_id"), 6).alias("pass_rate"))


@query("A20", """SELECT dept_id, term_id, count(*) AS n, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (PARTITION BY term_id), 4) AS pct_of_term
    FROM history GROUP BY 1, 2""", "history")
def a20_share_of_term(c: Campus):
    return aggregates.share(aggregates.counts(c.history, "dept_id", "term_id"), "n", "pct_of_term", ["term_id"], 4)


@query("A21", f"""WITH {STAR_SQL} SELECT department, year, season, term_id, count(enrollment_id) AS enrollment_count,
    count(DISTINCT student_id) AS unique_students, {GPA4} AS avg_gpa FROM star GROUP BY 1, 2, 3, 4""", STAR_NEEDS)
def a21_department_term_report(c: Campus):
    return star(c).groupBy("department", "year", "season", "term_id").agg(
        F.count("enrollment_id").alias("enrollment_count"), F.countDistinct("student_id").alias("unique_students"),
        values.exact_avg("gpa_points", 1, 4).alias("avg_gpa"))


@query("A21", f"""SELECT d.dept_id, d.name AS department, d.division, count(*) AS enrollments, {GPA4} AS avg_gpa,
    count(DISTINCT student_id) AS distinct_students FROM history JOIN department d USING (dept_id) GROUP BY 1, 2, 3""",
       "history department")
def a21_department_summary(c: Campus):
    """Aggregated by the key alone; names join the 25 result rows."""
    agg = c.history.groupBy("dept_id").agg(
        F.count("*").alias("enrollments"), values.exact_avg("gpa_points", 1, 4).alias("avg_gpa"),
        F.countDistinct("student_id").alias("distinct_students"))
    return agg.join(c.department.select("dept_id", F.col("name").alias("department"), "division"), "dept_id")


def busiest_departments(c: Campus, n: int):
    """The n departments with most enrolments; names join the n rows that are left."""
    agg = windows.top(aggregates.counts(c.history, "dept_id"), [F.desc("n"), F.col("dept_id")], n)
    return agg.join(c.department.select("dept_id", F.col("name").alias("department")), "dept_id").select("department", F.col("n").alias("enrollments"))


TOP_SQL = """SELECT d.name AS department, n AS enrollments FROM (SELECT dept_id, count(*) AS n FROM history GROUP BY 1 ORDER BY n DESC, dept_id LIMIT {}) JOIN department d USING (dept_id)"""


@query("A21 L02", TOP_SQL.format(15), "history department")
def a21_top_departments(c: Campus):
    return busiest_departments(c, 15)


@query("A23 L02", TOP_SQL.format(10), "history department")
def a23_largest_departments(c: Campus):
    return busiest_departments(c, 10)


@query("A21", f"WITH {STAR_SQL} SELECT year, count(enrollment_id) AS enrollment_count FROM star GROUP BY 1", STAR_NEEDS)
def a21_by_year(c: Campus):
    return star(c).groupBy("year").agg(F.count("enrollment_id").alias("enrollment_count"))


@query("A22", """SELECT count(*) AS total_rows, count(DISTINCT student_id) AS distinct_student_id,
    count(DISTINCT course_id) AS distinct_course_id, count(DISTINCT term_id) AS distinct_term_id FROM history""", "history")
def a22_table_scale(c: Campus):
    return aggregates.table_scale(c.history, ["student_id", "course_id", "term_id"])


@query("A23", "SELECT name AS department, status, count(*) AS students FROM student JOIN department USING (dept_id) GROUP BY 1, 2",
       "student department")
def a23_status_mix(c: Campus):
    mix = c.student.groupBy("dept_id", "status").agg(F.count("*").alias("students"))
    return mix.join(c.department.select("dept_id", F.col("name").alias("department")), "dept_id").drop("dept_id")


@query("A23", "SELECT t.year, t.season, count(DISTINCT student_id) AS students FROM enrollment JOIN term t USING (term_id) GROUP BY 1, 2",
       "enrollment term")
def a23_students_per_term(c: Campus):
    n = c.enrollment.groupBy("term_id").agg(F.countDistinct("student_id").alias("students"))
    return n.join(c.term.select("term_id", "year", "season"), "term_id").drop("term_id")


@query("A23", f"WITH {STAR_SQL} SELECT department, {GPA4} AS avg_gpa FROM star WHERE season = 'Fall' GROUP BY 1", STAR_NEEDS)
def a23_fall_gpa(c: Campus):
    return star(c).filter(F.col("season") == "Fall").groupBy("department").agg(
        values.exact_avg("gpa_points", 1, 4).alias("avg_gpa"))


@query("A23", """SELECT faculty_id, count(DISTINCT student_id) AS students FROM enrollment JOIN course USING (course_id) GROUP BY 1""",
       "enrollment course")
def a23_students_per_faculty(c: Campus):
    pairs = c.enrollment.join(c.course.select("course_id", "faculty_id"), "course_id")
    return pairs.groupBy("faculty_id").agg(F.countDistinct("student_id").alias("students"))


@query("A23", """WITH n AS (SELECT dept_id, term_id, count(*) AS n FROM history GROUP BY 1, 2)
    SELECT a.dept_id, a.term_id, a.n, b.n AS previous, a.n - b.n AS change FROM n a
    LEFT JOIN n b ON a.dept_id = b.dept_id AND a.term_id = b.term_id + 1""", "history")
def a23_term_over_term(c: Campus):
    n = aggregates.counts(c.history, "dept_id", "term_id")
    before = n.select("dept_id", (F.col("term_id") + 1).alias("term_id"), F.col("n").alias("previous"))
    return n.join(before, ["dept_id", "term_id"], "left").withColumn("change", F.col("n") - F.col("previous"))


# -- W, L: windows, sorts, top-k ---------------------------------------------


@query("W01", "SELECT dept_id, term_id, count(*) AS n, rank() OVER (PARTITION BY term_id ORDER BY count(*) DESC) AS rank_in_term FROM history GROUP BY 1, 2", "history")
def w01_rank_within_term(c: Campus):
    return windows.rank_aggregate(c.history, ["dept_id", "term_id"], {"n": F.count("*")}, ["term_id"], "n", "rank_in_term").withColumn(
        "rank_in_term", F.col("rank_in_term").cast("long"))


@query("W02 L01", """SELECT dept_id, d.name AS department, n AS enrollment_count, rank() OVER (ORDER BY n DESC) AS dept_rank
    FROM (SELECT dept_id, count(*) AS n FROM history GROUP BY 1) JOIN department d USING (dept_id)
    ORDER BY dept_rank, dept_id LIMIT 20""", "history department")
def w02_global_rank(c: Campus):
    ranked = windows.rank_aggregate(c.history, ["dept_id"], {"enrollment_count": F.count("*")}, [], "enrollment_count", "dept_rank")
    named = ranked.join(c.department.select("dept_id", F.col("name").alias("department")), "dept_id").withColumn(
        "dept_rank", F.col("dept_rank").cast("long"))
    return windows.top(named, [F.col("dept_rank"), F.col("dept_id")], 20)


@query("W03", """SELECT dept_id, term_id, n AS enrollments, sum(n) OVER (PARTITION BY dept_id ORDER BY term_id)::BIGINT AS running_total
    FROM (SELECT dept_id, term_id, count(*) AS n FROM history GROUP BY 1, 2)""", "history")
def w03_running_total(c: Campus):
    n = aggregates.counts(c.history, "dept_id", "term_id", out="enrollments")
    return ordered.running_total(n, ["dept_id"], [F.col("term_id")], F.col("enrollments"), "running_total",
                                 hot_rows=None)  # one row per term in a group


@query("W04", "SELECT * FROM enrollment QUALIFY row_number() OVER (PARTITION BY student_id ORDER BY term_id DESC, enrollment_id DESC) = 1", "enrollment")
def w04_last_enrollment(c: Campus):
    return windows.latest_per_key(c.enrollment, ["student_id"], ["term_id", "enrollment_id"])


@query("W04", "SELECT enrollment_id, student_id, term_id, row_number() OVER (PARTITION BY student_id ORDER BY term_id DESC, enrollment_id DESC) = 1 AS is_last FROM enrollment", "enrollment")
def w04_last_flag(c: Campus):
    return windows.flag_latest(c.enrollment.select("enrollment_id", "student_id", "term_id"), ["student_id"], ["term_id", "enrollment_id"])


def _heaviest(rows, key: str) -> int:
    """A threshold that the heaviest keys alone exceed, at any size fewer than 100,000 of them."""
    counts = rows.groupBy(key).agg(F.count("*").alias("n"))
    most, total = counts.agg(F.coalesce(F.max("n"), F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    return max(most - 1, total // 100_000)


ROLL_SQL = """SELECT enrollment_id, student_id, term_id, gpa_points, round(avg(gpa_points) OVER
    (PARTITION BY student_id ORDER BY term_id, enrollment_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 3) AS rolling_gpa FROM enrollment"""


def _rolling(c: Campus, **kw):
    rows = c.enrollment.select("enrollment_id", "student_id", "term_id", "gpa_points")
    return ordered.rolling_mean(rows, ["student_id"], [F.col("term_id"), F.col("enrollment_id")], "gpa_points", 3, "rolling_gpa", **kw)


@query("W05", ROLL_SQL, "enrollment")
def w05_rolling_mean(c: Campus):
    return _rolling(c)


@query("W05", ROLL_SQL, "enrollment")
def w05_rolling_mean_hot_keys(c: Campus):
    """The same rows, the heaviest keys on the path for keys too large for one task."""
    return _rolling(c, hot_rows=_heaviest(c.enrollment, "student_id"))


@query("W06", "SELECT job_id, name FROM job_names", "job_names")
def w06_current_names(c: Campus):
    from lakeloom.operators.telemetry import current_names

    return current_names(c.jobs, "job_id")


SEQ_SQL = "SELECT enrollment_id, student_id, term_id, row_number() OVER (PARTITION BY student_id ORDER BY term_id, enrollment_id) AS enrollment_seq FROM enrollment"


def _sequence(c: Campus, **kw):
    rows = c.enrollment.select("enrollment_id", "student_id", "term_id")
    return ordered.sequence_number(rows, ["student_id"], [F.col("term_id"), F.col("enrollment_id")], "enrollment_seq", **kw)


@query("W07", SEQ_SQL, "enrollment")
def w07_sequence_number(c: Campus):
    return _sequence(c)


@query("W07", SEQ_SQL, "enrollment")
def w07_sequence_number_hot_keys(c: Campus):
    """The same rows, the heaviest keys on the path for keys too large for one task."""
    return _sequence(c, hot_rows=_heaviest(c.enrollment, "student_id"))


@query("W08", """SELECT dept_id, course_id, count(*) AS n, row_number() OVER (PARTITION BY dept_id ORDER BY count(*) DESC, course_id) AS popularity
    FROM enrollment JOIN course USING (course_id) GROUP BY 1, 2""", "enrollment course")
def w08_popularity(c: Campus):
    rows = c.enrollment.join(c.course.select("course_id", "dept_id"), "course_id")
    ranked = windows.rank_aggregate(rows, ["dept_id", "course_id"], {"n": F.count("*")}, ["dept_id"], "n", "popularity",
                                    "row_number", ["course_id"], many=True)
    return ranked.withColumn("popularity", F.col("popularity").cast("long"))


@query("W09", """SELECT enrollment_id, dept_id, gpa_points, rank() OVER (PARTITION BY dept_id ORDER BY gpa_points DESC NULLS LAST) AS gpa_rank
    FROM enrollment JOIN student USING (student_id)""", "enrollment student")
def w09_rank_by_points(c: Campus):
    rows = c.enrollment.join(c.student.select("student_id", "dept_id"), "student_id").select("enrollment_id", "dept_id", "gpa_points")
    return ordered.rank_in_group(rows, ["dept_id"], "gpa_points", "gpa_rank")


@query("L01", """SELECT student_id, count(*) AS n FROM history GROUP BY 1 ORDER BY n DESC, student_id LIMIT 15""", "history")
def l01_top_students(c: Campus):
    return windows.top(aggregates.counts(c.history, "student_id"), [F.desc("n"), F.col("student_id")], 15)


@query("L03", """(SELECT 'first' AS side, student_id FROM student ORDER BY student_id LIMIT 10)
    UNION ALL (SELECT 'last', student_id FROM student ORDER BY student_id DESC LIMIT 5)""", "student")
def l03_boundary_keys(c: Campus):
    first = windows.boundary_keys(c.student, "student_id", 10).withColumn("side", F.lit("first"))
    last = windows.boundary_keys(c.student, "student_id", 5, last=True).withColumn("side", F.lit("last"))
    return first.unionByName(last)


@query("L04", f"""SELECT t.term_id, t.year, t.season, t.year || ' ' || t.season AS term_label, count(*) AS enrollments,
    count(DISTINCT student_id) AS distinct_students, {GPA4} AS avg_gpa FROM history JOIN term t USING (term_id) GROUP BY 1, 2, 3, 4 ORDER BY 1""", "history term")
def l04_chronological_trend(c: Campus):
    agg = c.history.groupBy("term_id").agg(F.count("*").alias("enrollments"), F.countDistinct("student_id").alias("distinct_students"),
                                           values.exact_avg("gpa_points", 1, 4).alias("avg_gpa"))
    label = c.term.select("term_id", "year", "season", F.concat("year", F.lit(" "), "season").alias("term_label"))
    return agg.join(label, "term_id").orderBy("term_id")


# -- U: sets --------------------------------------------------------------------


@query("U03", """SELECT student_id, CASE WHEN dept_id = 3 THEN 'graduated' ELSE status END AS status FROM student
    UNION ALL SELECT student_id + 900000000, 'active' FROM student WHERE status = 'leave'""", "student")
def u03_union_by_name(c: Campus):
    base = c.student.select("student_id", F.when(F.col("dept_id") == 3, "graduated").otherwise(F.col("status")).alias("status"))
    new = c.student.filter(F.col("status") == "leave").select(F.lit("active").alias("status"), (F.col("student_id") + 900000000).alias("student_id"))
    return base.unionByName(new)


@query("U04", "SELECT student_id FROM student EXCEPT SELECT student_id FROM enrollment WHERE grade = 'F'", "student enrollment")
def u04_subtract(c: Campus):
    return c.student.select("student_id").subtract(c.enrollment.filter(F.col("grade") == "F").select("student_id"))


@query("U05", "SELECT DISTINCT student_id, grade FROM enrollment", "enrollment")
def u05_dedupe(c: Campus):
    return c.enrollment.select("student_id", "grade").dropDuplicates()


# -- F: scalar functions ------------------------------------------------------------


@query("F01", """SELECT student_id, upper(trim(last_name)) || ', ' || upper(first_name[1]) || lower(first_name[2:]) AS full_name,
    lower(first_name) AS lower_name, first_name || ' ' || last_name AS display_name FROM student""", "student")
def f01_names(c: Campus):
    return c.student.select("student_id", text.formal_name("last_name", "first_name").alias("full_name"),
                            F.lower("first_name").alias("lower_name"), text.display_name("first_name", "last_name").alias("display_name"))


@query("F02", r"""SELECT student_id, CASE WHEN email IS NOT NULL THEN split_part(email, '@', 2) END AS email_domain,
    first_name[1] || regexp_replace(last_name, '[^A-Za-z]', '', 'g')[1] AS initials, right(ssn, 4) AS last4,
    regexp_replace('  a ' || last_name || '   b', '\s+', ' ', 'g')[1:12] AS squeezed, trim('  ' || last_name || ' ') AS trimmed
    FROM student""", "student")
def f02_slices(c: Campus):
    return c.student.select(
        "student_id", text.after("email", "@").alias("email_domain"), text.initials("first_name", "last_name").alias("initials"),
        F.right("ssn", F.lit(4)).alias("last4"),
        text.squeeze(F.concat(F.lit("  a "), "last_name", F.lit("   b")), 12).alias("squeezed"),
        F.trim(F.concat(F.lit("  "), "last_name", F.lit(" "))).alias("trimmed"))


@query("F03", "SELECT student_id, dob, born AS dob_parsed FROM student", "student")
def f03_mixed_dates(c: Campus):
    return c.student.select("student_id", "dob", dates.parse_mixed_date("dob").alias("dob_parsed"))


@query("F04", """SELECT student_id, year(born)::INTEGER AS birth_year, dayname(born) AS birth_dow,
    floor((DATE '2024-09-01' - born) / 365.25::DOUBLE)::INTEGER AS age_years, (2024 - year(born))::INTEGER AS age_by_year FROM student""", "student")
def f04_date_parts(c: Campus):
    born = dates.parse_mixed_date("dob")
    return c.student.select("student_id", F.year(born).alias("birth_year"), dates.weekday(born).alias("birth_dow"),
                            dates.age_years(born, "2024-09-01").alias("age_years"), dates.age_by_year(born, "2024-09-01").alias("age_by_year"))


@query("F05", """SELECT event_id, timezone('America/New_York', timezone('UTC', ts)) AS eastern,
    timezone('America/Los_Angeles', timezone('UTC', ts)) AS pacific FROM events""")
def f05_time_zones(c: Campus):
    return c.raw("events").select("event_id", dates.in_zone(F.col("ts"), "America/New_York").alias("eastern"),
                                  dates.in_zone(F.col("ts"), "America/Los_Angeles").alias("pacific"))


@query("F06", """SELECT event_id, date_trunc('hour', ts) AS hour, ts::DATE AS day, date_trunc('month', ts)::DATE AS month,
    day(ts)::INTEGER AS day_of_month, last_day(ts) AS month_end FROM events""")
def f06_time_buckets(c: Campus):
    ts = F.col("ts")
    return c.raw("events").select(
        "event_id", F.date_trunc("HOUR", ts).cast("timestamp_ntz").alias("hour"), ts.cast("date").alias("day"),
        F.trunc(ts, "MM").alias("month"), F.dayofmonth(ts).alias("day_of_month"), F.last_day(ts).alias("month_end"))


@query("F07", """SELECT statement_id, round((epoch(date_trunc('second', end_time)) - epoch(date_trunc('second', start_time))) / 60.0::DOUBLE, 2) AS minutes
    FROM query_history""", "query_history")
def f07_durations(c: Campus):
    return c.query_history.select("statement_id", dates.minutes_between(F.col("start_time"), F.col("end_time")).alias("minutes"))


@query("F08", """SELECT o_orderkey, round(o_totalprice, 1) AS r1, round(o_totalprice, -3) AS thousands, floor(o_totalprice)::BIGINT AS whole,
    o_orderkey % 7 AS remainder, round(o_totalprice / nullif(o_orderkey % 7, 0), 4) AS guarded FROM orders""")
def f08_math(c: Campus):
    x = F.col("o_totalprice")
    return c.raw("orders").select(
        "o_orderkey", F.round(x, 1).alias("r1"), F.round(x, -3).alias("thousands"), F.floor(x).alias("whole"),
        (F.col("o_orderkey") % 7).alias("remainder"), F.round(x / F.nullif(F.col("o_orderkey") % 7, F.lit(0)), 4).alias("guarded"))


@query("F09", "SELECT student_id, coalesce(email, 'none@campus.example') AS email_filled FROM student", "student")
def f09_null_defaults(c: Campus):
    return c.student.select("student_id", F.coalesce("email", F.lit("none@campus.example")).alias("email_filled"))


@query("F12", """SELECT o_orderkey, 'segment' AS tag_key, c_mktsegment AS tag_value FROM orders JOIN customer ON o_custkey = c_custkey
    UNION ALL SELECT o_orderkey, 'priority', o_orderpriority FROM orders JOIN customer ON o_custkey = c_custkey""")
def f12_map_explode(c: Campus):
    customer = c.raw("customer").select("c_custkey", "c_mktsegment")
    rows = c.raw("orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
    tags = F.create_map(F.lit("segment"), F.col("c_mktsegment"), F.lit("priority"), F.col("o_orderpriority"))
    return rows.select("o_orderkey", F.explode(tags).alias("tag_key", "tag_value"))


@query("F13", """SELECT event_id, k, k * 2 AS doubled, 'user' || k AS first_principal FROM ev""", "ev")
def f13_nested_json(c: Campus):
    shape = "array<struct<principal:string,add:array<string>>>"
    changes = c.raw("events").select(
        "event_id", F.from_json("props", "k int").alias("p")).select(
        "event_id", F.col("p.k").alias("k"),
        F.from_json(F.concat(F.lit('[{"principal":"user'), F.col("p.k"), F.lit('","add":["SELECT"]}]')), shape).alias("c"))
    return changes.select("event_id", "k", (F.col("k") * 2).alias("doubled"), F.col("c")[0]["principal"].alias("first_principal"))


@query("F15", "SELECT student_id, 'wksp_' || regexp_replace(email, '[^a-zA-Z0-9]', '_', 'g') AS schema_name FROM student", "student")
def f15_schema_names(c: Campus):
    return c.student.select("student_id", text.identifier("email").alias("schema_name"))


@query("F16", "SELECT grade, gpa_points, count(*) AS n, 0::BIGINT AS mismatches FROM history GROUP BY 1, 2", "history")
def f16_grade_points_parity(c: Campus):
    mapped = values.points("grade")
    return c.history.groupBy("grade", mapped.alias("gpa_points")).agg(
        F.count("*").alias("n"), F.sum(F.when(mapped.eqNullSafe(F.col("gpa_points")), 0).otherwise(1)).alias("mismatches"))


# -- Q: quality --------------------------------------------------------------------


@query("Q01", f"WITH {STAGED_SQL} SELECT * FROM staged WHERE gpa_typed IS NOT NULL OR gpa_raw IS NULL", "enrollment")
def q01_expect_or_drop(c: Campus):
    kept, _ = quality.expect_or_drop(staged_casts(c), "gpa_castable", F.col("gpa_typed").isNotNull() | F.col("gpa_raw").isNull())
    return kept


@query("Q01", f"WITH {STAGED_SQL} SELECT 'gpa_castable' AS expectation, count(*) AS seen, sum(CASE WHEN gpa_typed IS NULL AND gpa_raw IS NOT NULL THEN 1 ELSE 0 END)::BIGINT AS dropped FROM staged", "enrollment")
def q01_drop_counts(c: Campus):
    """What the expectation saw and dropped, observed while the kept rows are written."""
    kept, seen = quality.expect_or_drop(staged_casts(c), "gpa_castable", F.col("gpa_typed").isNotNull() | F.col("gpa_raw").isNull())
    durable(kept, "kept")
    return c.spark.createDataFrame([("gpa_castable", seen.get["seen"], seen.get["dropped"])], "expectation string, seen long, dropped long")


@query("Q02", f"WITH {STAGED_SQL} SELECT enrollment_id, gpa_raw, gpa_raw IS NOT NULL AND gpa_typed IS NULL AS rejected FROM staged", "enrollment")
def q02_quarantine(c: Campus):
    valid, rejects = quality.quarantine(staged_casts(c), F.col("gpa_raw").isNotNull() & F.col("gpa_typed").isNull())
    return valid.select("enrollment_id", "gpa_raw", F.lit(False).alias("rejected")).unionByName(
        rejects.select("enrollment_id", "gpa_raw", F.lit(True).alias("rejected")))


@query("Q03", "SELECT sum(n)::BIGINT AS covered, (SELECT count(*) FROM history) AS expected, true AS passed FROM (SELECT term_id, count(*) AS n FROM history GROUP BY 1)", "history")
def q03_completeness(c: Campus):
    return quality.coverage(aggregates.counts(c.history, "term_id"), "n", c.raw("lineitem"))


@query("Q05", """SELECT 'not_empty' AS check_name, count(*) > 0 AS passed, count(*)::DOUBLE AS value FROM enrollment
    UNION ALL SELECT 'points_low', min(gpa_points) >= 0, min(gpa_points) FROM enrollment
    UNION ALL SELECT 'points_high', max(gpa_points) <= 4, max(gpa_points) FROM enrollment
    UNION ALL SELECT 'unique_id', count(*) = count(DISTINCT enrollment_id), count(DISTINCT enrollment_id)::DOUBLE FROM enrollment""", "enrollment")
def q05_gates(c: Campus):
    gpa = F.col("gpa_points")
    return quality.gates(c.enrollment, {
        "not_empty": (F.count("*"), F.count("*") > 0),
        "points_low": (F.min(gpa), F.min(gpa) >= 0), "points_high": (F.max(gpa), F.max(gpa) <= 4),
        "unique_id": (F.countDistinct("enrollment_id"), F.count("*") == F.countDistinct("enrollment_id"))})


@query("Q05", "SELECT count(DISTINCT dept_id) AS ranks, 0::BIGINT AS violations FROM history", "history")
def q05_rank_order_gate(c: Campus):
    """Ranked departments whose successor is larger: there must be none."""
    ranked = windows.rank_aggregate(c.history, ["dept_id"], {"n": F.count("*")}, [], "n", "dept_rank", "row_number", ["dept_id"])
    wrong = quality.unsorted_pairs(ranked, "dept_rank", "n").agg(F.count("*")).scalar()
    return ranked.agg(F.count("*").alias("ranks")).withColumn("violations", wrong)


@query("Q06", f"SELECT sum(enrollments)::BIGINT AS covered, (SELECT count(*) FROM history) AS expected, true AS passed FROM ({BAND_SQL})", "history")
def q06_band_completeness(c: Campus):
    return quality.coverage(p05_point_bands(c), "enrollments", c.history)


@query("Q07", "SELECT 'null_ages' AS check_name, true AS passed, 0.0::DOUBLE AS value FROM student LIMIT 1", "student")
def q07_parse_failures(c: Campus):
    rate = F.count_if(dates.parse_mixed_date("dob").isNull()) / F.count("*")
    return quality.gates(c.student, {"null_ages": (rate, rate < 0.01)})


def _profile_sql(table: str, col: str, numeric: bool, low=None, high=None) -> str:
    x = col if numeric else "NULL::DOUBLE"
    out = f"sum(CASE WHEN {col} NOT BETWEEN {low} AND {high} THEN 1 ELSE 0 END)::BIGINT" if low is not None else "0::BIGINT"
    return f"""SELECT '{col}' AS column_name, count(*) AS row_count, round(100.0::DOUBLE * (count(*) - count({col})) / count(*), 4) AS null_pct,
        count(DISTINCT {col}) AS distinct_count, round(avg({x}), 4) AS mean, round(stddev_samp({x}), 3) AS stddev,
        min({x})::DOUBLE AS min_value, max({x})::DOUBLE AS max_value, {out} AS outliers FROM {table}"""


@query("Q08", " UNION ALL ".join([_profile_sql("history", "gpa_points", True, 0.5, 4.0), _profile_sql("history", "course_id", True),
                                  _profile_sql("history", "grade", False)]), "history")
def q08_column_profile(c: Campus):
    return quality.profile(c.history, ["gpa_points", "course_id", "grade"], {"gpa_points": (0.5, 4.0)})


FREQUENT = ["grade", "dept_id", "course_id", "student_id"]


@query("Q08 A12", " UNION ALL ".join(
    f"""SELECT '{col}' AS column_name, {col}::VARCHAR AS value, count(*) AS n, round(count(*)::DOUBLE / (SELECT count(*) FROM history), 6) AS share
    FROM history WHERE {col} IS NOT NULL GROUP BY 2 HAVING count(*) >= 0.01::DOUBLE * (SELECT count(*) FROM history)""" for col in FREQUENT), "history")
def q08_frequent_values(c: Campus):
    return quality.frequent_values(c.history, FREQUENT)


@query("Q09", """WITH f AS (SELECT grade, count(*) FILTER (term_id <= 9) AS a, count(*) FILTER (term_id > 9) AS b FROM history GROUP BY 1)
    SELECT 'grade' AS column_name, 'total_variation' AS metric, round(sum(abs(a / (SELECT sum(a) FROM f)::DOUBLE - b / (SELECT sum(b) FROM f)::DOUBLE)) / 2, 6) AS distance,
    sum(abs(a / (SELECT sum(a) FROM f)::DOUBLE - b / (SELECT sum(b) FROM f)::DOUBLE)) / 2 > 0.05 AS drifted FROM f""", "history")
def q09_grade_drift(c: Campus):
    return quality.categorical_drift(c.history.filter("term_id <= 9"), c.history.filter("term_id > 9"), "grade", 0.05)


@query("Q09", """WITH f AS (SELECT o_totalprice AS x, count(*) FILTER (o_orderstatus = 'F') AS a, count(*) FILTER (o_orderstatus = 'O') AS b FROM orders
      WHERE o_orderstatus IN ('F', 'O') GROUP BY 1),
    g AS (SELECT abs(sum(a) OVER (ORDER BY x) / (SELECT sum(a) FROM f)::DOUBLE - sum(b) OVER (ORDER BY x) / (SELECT sum(b) FROM f)::DOUBLE) AS d FROM f)
    SELECT 'o_totalprice' AS column_name, 'ks' AS metric, round(max(d), 6) AS distance, max(d) > 0.05 AS drifted FROM g""")
def q09_price_drift(c: Campus):
    orders = c.raw("orders")
    return quality.numeric_drift(orders.filter("o_orderstatus = 'F'"), orders.filter("o_orderstatus = 'O'"), "o_totalprice", 0.05)
