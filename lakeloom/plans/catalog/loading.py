"""Sources, sinks, change capture, streams and the learning job.

Each query that needs files first writes them, from the given tables, to a new
folder below the shared folder, and reads them back with the operator.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructType

from lakeloom.functions.fixed import GRADE_POINTS, GRADE_WEIGHTS
from lakeloom.operators import aggregates, cdc, learning, ordered
from lakeloom.plans.campus import Campus
from lakeloom.plans.registry import query
from lakeloom.session import durable, scratch_path
from lakeloom.sinks import files as out
from lakeloom.sinks import tables
from lakeloom.sources import files, generate, paged, workbook
from lakeloom.streaming import cdc as stream_cdc
from lakeloom.streaming.evolving import stream_evolving
from lakeloom.streaming.files import stream_checkpoint, stream_files

# -- S: sources -------------------------------------------------------------------

QUOTED = """SELECT student_id, CASE WHEN dept_id = 3 THEN 'Doe, ' || last_name WHEN dept_id = 4 THEN 'line' || chr(10) || last_name
    ELSE last_name END AS last_name, status FROM student"""


def quoted_students(c: Campus):
    """Names holding the separator, or a line break, in some departments."""
    name = F.col("last_name")
    tricky = (F.when(F.col("dept_id") == 3, F.concat(F.lit("Doe, "), name))
              .when(F.col("dept_id") == 4, F.concat(F.lit("line\n"), name)).otherwise(name))
    return c.student.select("student_id", tricky.alias("last_name"), "status")


@query("S01 K04", QUOTED, "student")
def s01_quoted_multiline_csv(c: Campus):
    path = scratch_path(c.spark, "csv")
    out.export_delimited(quoted_students(c), path, quote_all=True)
    return files.read_delimited(c.spark, path, multiline=True, schema="student_id long, last_name string, status string")


@query("S02 K05", "SELECT enrollment_id, CASE WHEN grade = 'A' THEN 'A|provisional' ELSE grade END AS grade, gpa_points FROM enrollment", "enrollment")
def s02_pipe_delimited(c: Campus):
    path = scratch_path(c.spark, "pipe")
    graded = c.enrollment.select(
        "enrollment_id", F.when(F.col("grade") == "A", "A|provisional").otherwise(F.col("grade")).alias("grade"), "gpa_points")
    out.export_delimited(graded, path, sep="|")
    return files.read_delimited(c.spark, path, sep="|", schema="enrollment_id long, grade string, gpa_points double")


UPLOAD = StructType().add("dept_id", LongType()).add("external_rank", IntegerType()).add("benchmark_score", DoubleType())


def _upload(c: Campus, broken: bool) -> str:
    path = scratch_path(c.spark, "upload")
    rank = F.col("o_orderkey").cast("string")
    if broken:
        rank = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("n/a")).otherwise(rank)
    rows = c.raw("orders").select(F.col("o_custkey").alias("dept_id"), rank.alias("external_rank"), F.col("o_totalprice").alias("benchmark_score"))
    out.export_delimited(rows, path, single=False)
    return path


@query("S03", """SELECT o_custkey AS dept_id, CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderkey::INTEGER END AS external_rank,
    o_totalprice AS benchmark_score, o_orderpriority = '1-URGENT' AS corrupt FROM orders""")
def s03_explicit_schema_upload(c: Campus):
    rows = files.read_upload(c.spark, _upload(c, broken=True), UPLOAD)
    return rows.select("dept_id", "external_rank", "benchmark_score", F.col(files.CORRUPT).isNotNull().alias("corrupt"))


@query("S04", "SELECT o_custkey::INTEGER AS dept_id, o_orderkey::INTEGER AS external_rank, o_totalprice AS benchmark_score FROM orders")
def s04_inferred_upload(c: Campus):
    return files.read_upload(c.spark, _upload(c, broken=False))


AID = StructType().add("aid_id", LongType()).add("student_id", LongType()).add("amount", DoubleType()).add("aid_type", StringType())


@query("S05 K09", "SELECT aid_id, student_id, amount, aid_type FROM aid", "aid")
def s05_workbooks(c: Campus):
    """Exported to one workbook per aid type and task, then read back by sheet name."""
    path = scratch_path(c.spark, "books")
    workbook.export_workbooks(c.aid.select("aid_id", "student_id", "amount", "aid_type"), path, "AidDetail", "aid_type",
                              cover={"Summary": [("kind", "n"), ("all", 1)], "Notes": [("no data here",)]})
    return workbook.read_workbooks(c.spark, path, "AidDetail", AID)


@query("S06 K07 A08", """SELECT dept_id, course_id, title, CASE WHEN course_id % 2 = 0 THEN 'CRS-' || (course_id - 1) END AS prerequisite FROM course""", "course")
def s06_nested_json(c: Campus):
    """Optional keys are left out of the file and come back as NULL."""
    path = scratch_path(c.spark, "json")
    courses = c.course.withColumn("prerequisite", F.when(F.col("course_id") % 2 == 0, F.concat(F.lit("CRS-"), F.col("course_id") - 1)))
    out.export_json(ordered.nest_rows(courses, ["dept_id"], [F.col("course_id")], ["course_id", "title", "prerequisite"], "courses"), path)
    shape = "dept_id long, part int, courses array<struct<course_id:long,title:string,prerequisite:string>>"
    return files.read_json(c.spark, path, schema=shape).select("dept_id", F.inline("courses"))


@query("S07 K08", "SELECT faculty_id, name, rank, CASE WHEN faculty_id % 3 = 0 THEN true END AS tenure FROM faculty", "faculty")
def s07_xml(c: Campus):
    path = scratch_path(c.spark, "xml")
    rows = c.faculty.select("faculty_id", "name", "rank", F.when(F.col("faculty_id") % 3 == 0, True).alias("tenure"))
    out.export_xml(rows, path, "member", "faculty")
    return files.read_xml(c.spark, path, "member", "faculty_id long, name string, rank string, tenure boolean")


def _streamed(c: Campus, fmt: str, path: str, schema, **options):
    """Two runs over the same files; the second must add nothing."""
    work = scratch_path(c.spark, "stream")
    for _ in range(2):
        rows = stream_files(c.spark, fmt, path, stream_checkpoint(work, "ana@campus.example", fmt), f"{work}/bronze", schema, options)
    return rows.drop("source_file")


@query("S08 R01 R02 R03", "SELECT s_suppkey::INTEGER AS faculty_id, s_name AS name, s_acctbal AS balance FROM supplier")
def s08_stream_csv(c: Campus):
    """Schema inferred once by a batch read and kept beside the checkpoint."""
    path = scratch_path(c.spark, "in")
    rows = c.raw("supplier").select(F.col("s_suppkey").alias("faculty_id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    out.export_delimited(rows, path, single=False)
    return _streamed(c, "csv", path, None)


@query("S08 R01", "SELECT enrollment_id, grade, gpa_points FROM enrollment", "enrollment")
def s08_stream_json(c: Campus):
    path = scratch_path(c.spark, "in")
    out.export_json(c.enrollment.select("enrollment_id", "grade", "gpa_points"), path)
    return _streamed(c, "json", path, "enrollment_id long, grade string, gpa_points double")


@query("S08 R01", "SELECT faculty_id, name, rank FROM faculty", "faculty")
def s08_stream_xml(c: Campus):
    path = scratch_path(c.spark, "in")
    out.export_xml(c.faculty.select("faculty_id", "name", "rank"), path, "member", "faculty")
    return _streamed(c, "xml", path, "faculty_id long, name string, rank string", rowTag="member")


@query("S08 R01", "SELECT course_id, title FROM course", "course")
def s08_stream_pipe(c: Campus):
    path = scratch_path(c.spark, "in")
    out.export_delimited(c.course.select("course_id", "title"), path, sep="|", single=False)
    return _streamed(c, "csv", path, "course_id long, title string", sep="|")


@query("S08 R01 R02", """SELECT enrollment_id, CASE WHEN enrollment_id % 7 > 0 THEN gpa_points END AS gpa_points, CASE WHEN term_id > 9 THEN grade END AS grade,
    CASE WHEN enrollment_id % 7 = 0 THEN 'pending' END AS unfit FROM enrollment""", "enrollment")
def r02_evolving_stream(c: Campus):
    """Two drops: the second brings a column, both hold values that do not fit; every one is kept."""
    path, work = scratch_path(c.spark, "in"), scratch_path(c.spark, "stream")
    points = F.when(F.col("enrollment_id") % 7 == 0, F.lit('"pending"')).otherwise(F.coalesce(F.col("gpa_points").cast("string"), F.lit("null")))
    old = F.format_string('{"enrollment_id":%d,"gpa_points":%s}', "enrollment_id", points)
    new = F.format_string('{"enrollment_id":%d,"gpa_points":%s,"grade":%s}', "enrollment_id", points,
                          F.coalesce(F.concat(F.lit('"'), "grade", F.lit('"')), F.lit("null")))
    late = F.coalesce(F.col("term_id") > 9, F.lit(False))
    for part, lines in (("first", c.enrollment.filter(~late).select(old)), ("second", c.enrollment.filter(late).select(new))):
        lines.write.text(f"{path}/{part}")
        rows = stream_evolving(c.spark, path, f"{work}/check", f"{work}/bronze", "enrollment_id long, gpa_points double")
    if "grade" not in rows.columns:  # no row of the second drop has one
        rows = rows.withColumn("grade", F.lit(None).cast("string"))
    return rows.select("enrollment_id", "gpa_points", "grade", F.col("rescued")["gpa_points"].alias("unfit"))


@query("S09 K06", """SELECT aid_id, amount, CASE o_orderstatus WHEN 'F' THEN DATE '2024-01-01' WHEN 'O' THEN DATE '2024-01-02' ELSE DATE '2024-01-03' END AS file_date
    FROM aid JOIN orders ON o_orderkey = aid_id""", "aid")
def s09_dated_files(c: Campus):
    """Three dated drops and one file whose name does not match."""
    path = scratch_path(c.spark, "drop")
    orders = c.raw("orders").select(F.col("o_orderkey").alias("aid_id"), F.col("o_totalprice").alias("amount"), "o_orderstatus")
    for status, day in {"F": "20240101", "O": "20240102", "P": "20240103"}.items():
        part = orders.filter(F.col("o_orderstatus") == status).drop("o_orderstatus")
        out.export_single_file(part, f"{path}/financial_aid_{day}.csv", sep=",")
    out.export_single_file(c.department, f"{path}/department.csv", sep=",")
    rows = files.read_dated(c.spark, path, "financial_aid_*.csv", "aid_id long, amount double")
    return rows.drop("file_name")


@query("S10 Q03", "SELECT aid_id, student_id, amount, aid_type FROM aid", "aid")
def s10_paged_extract(c: Campus):
    """Pages fetched in parallel; the token expires on the way; all records must arrive."""
    root, size = scratch_path(c.spark, "pages"), 1000
    numbered = ordered.sequence_number(c.aid.drop("term_id"), [], [F.col("aid_id")], "_seq")
    pages = numbered.withColumn("page", F.floor((F.col("_seq") - 1) / size) + 1).drop("_seq")
    pages.repartition("page").write.partitionBy("page").json(root)
    total = c.size("orders")
    fetcher = paged.FilePages(root, size, total, expire_at=2)
    rows = paged.read_pages(c.spark, fetcher, AID, page_size=size, parallel=8)
    paged.require_complete(rows, total)
    return rows


@query("S11", """SELECT enrollment_id, student_id, grade, (SELECT count(*) FROM enrollment) > 300 AS has_next FROM enrollment
    ORDER BY enrollment_id LIMIT 100 OFFSET 200""", "enrollment")
def s11_page_slice(c: Campus):
    return files.page(c.enrollment.select("enrollment_id", "student_id", "grade"), "enrollment_id", 3, 100)


@query("S11", "SELECT enrollment_id, grade FROM enrollment WHERE enrollment_id > 777 ORDER BY enrollment_id LIMIT 100", "enrollment")
def s11_keyset_page(c: Campus):
    return files.keyset_page(c.enrollment.select("enrollment_id", "grade"), "enrollment_id", 777, 100)


@query("S13", """SELECT s.dept_id, count(DISTINCT e.enrollment_id) AS enrollment_count,
    round(sum(round(gpa_points * 10)::BIGINT)::DOUBLE / count(gpa_points) / 10, 4) AS avg_gpa, min(e.grade) AS min_grade, max(e.grade) AS max_grade
    FROM student s LEFT JOIN enrollment e ON s.student_id = e.student_id GROUP BY 1""", "student enrollment")
def s13_custom_extract(c: Campus):
    """The extract's join and aggregate, which over JDBC runs as a pushed query."""
    return c.spark.sql(
        "SELECT s.dept_id, count(DISTINCT e.enrollment_id) AS enrollment_count, "
        "round(sum(cast(round(e.gpa_points * 10) AS bigint)) / count(e.gpa_points) / 10, 4) AS avg_gpa, "
        "min(e.grade) AS min_grade, max(e.grade) AS max_grade "
        "FROM {s} s LEFT JOIN {e} e ON s.student_id = e.student_id GROUP BY s.dept_id", s=c.student, e=c.enrollment)


@query("S14 K01", "SELECT student_id, dept_id, status FROM student", "student")
def s14_catalog_table(c: Campus):
    """Written twice with different columns: the second write replaces data and schema."""
    name, path = f"lakeloom_{uuid4().hex}", scratch_path(c.spark, "table")
    tables.write_table(c.student.select("student_id"), name, path)
    return tables.write_table(c.student.select("student_id", "dept_id", "status"), name, path)


@query("S15", "SELECT (SELECT count(*) FROM lineitem) AS n, 0::BIGINT AS without_department, true AS weights_hold")
def s15_generated_fact(c: Campus):
    """As many generated rows as the large table has, drawn over its students and courses."""
    rows = c.size("lineitem")
    fact = generate.generate_fact(c.spark, rows, c.student, c.size("part"), 24)
    shares = [F.abs(F.count_if(F.col("grade") == g) / rows - w / sum(GRADE_WEIGHTS)) < 0.02 for g, w in zip(GRADE_POINTS, GRADE_WEIGHTS)]
    holds = shares[0]
    for share in shares[1:]:
        holds = holds & share
    return fact.agg(F.count("*").alias("n"), F.count_if(F.col("dept_id").isNull()).alias("without_department"), holds.alias("weights_hold"))


@query("S16", """SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN upper(c_name) ELSE c_name END AS c_name,
    CASE WHEN c_custkey % 50 <> 0 THEN c_mktsegment END AS c_mktsegment,
    CASE c_custkey % 3 WHEN 0 THEN '2001-02-03' WHEN 1 THEN '02/03/2001' ELSE '03.02.2001' END AS dob FROM customer""")
def s16_planted_dirt(c: Campus):
    planted = generate.plant(c.raw("customer").select("c_custkey", "c_name", "c_mktsegment"), "c_custkey",
                             {"c_name": (5, F.upper("c_name")), "c_mktsegment": (50, F.lit(None).cast("string"))})
    return planted.withColumn("dob", generate.dirty_dates("c_custkey", F.lit("2001-02-03").cast("date")))


@query("S17", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '2000-01-01'")
def s17_changed_since(c: Campus):
    import datetime as dt

    rows, _ = files.changed_since(c.raw("orders").select("o_orderkey", "o_orderdate"), "o_orderdate", dt.datetime(2000, 1, 1))
    return rows


# -- K: target loading ----------------------------------------------------------------


@query("K02", "SELECT ts::DATE AS run_date, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY 1")
def k02_replace_partition(c: Campus):
    """All days loaded, then the last ten loaded again: nothing is doubled."""
    path = scratch_path(c.spark, "days")
    days = c.raw("events").groupBy(F.col("ts").cast("date").alias("run_date")).agg(
        F.count("*").alias("n"), F.countDistinct("user_id").alias("users"))
    tables.replace_partition(days, path, "run_date")
    return tables.replace_partition(days.filter("run_date >= '2024-01-20'"), path, "run_date").select("run_date", "n", "users")


@query("K03", "SELECT dept_id, count(*) AS n FROM history WHERE term_id = 9 GROUP BY 1", "history")
def k03_clustered_fact(c: Campus):
    """Directory per term, sorted by department: the filter opens one directory."""
    path = scratch_path(c.spark, "clustered")
    fact = tables.write_clustered(c.history.select("enrollment_id", "term_id", "dept_id"), path, "term_id", ["dept_id"])
    return fact.filter(F.col("term_id") == 9).groupBy("dept_id").agg(F.count("*").alias("n"))


@query("K03", "SELECT term_id, count(*) AS n FROM history WHERE dept_id = 3 GROUP BY 1", "history")
def k03_interleaved_fact(c: Campus):
    """Laid out by term and department at once; the filter on the second key alone skips most files."""
    rows = c.history.select("enrollment_id", "term_id", "dept_id")
    fact = tables.write_interleaved(rows, scratch_path(c.spark, "interleaved"), ["term_id", "dept_id"], files=32)
    return fact.filter(F.col("dept_id") == 3).groupBy("term_id").agg(F.count("*").alias("n"))


@query("K03", "SELECT o_orderstatus, count(*) AS n, sum(l_quantity)::BIGINT AS units FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1")
def k03_bucketed_join(c: Campus):
    """Both tables bucketed by order key: the join itself moves nothing."""
    stem = uuid4().hex
    lines = tables.write_bucketed(c.raw("lineitem").select(F.col("l_orderkey").alias("order_key"), "l_quantity"),
                                  f"lakeloom_lines_{stem}", scratch_path(c.spark, "lines"), ["order_key"], 8)
    orders = tables.write_bucketed(c.raw("orders").select(F.col("o_orderkey").alias("order_key"), "o_orderstatus"),
                                   f"lakeloom_orders_{stem}", scratch_path(c.spark, "orders"), ["order_key"], 8)
    return lines.join(orders, "order_key").groupBy("o_orderstatus").agg(
        F.count("*").alias("n"), F.sum("l_quantity").cast("long").alias("units"))


MERGE = """t AS (SELECT student_id, dept_id, status FROM student WHERE status <> 'graduated'),
    s AS (SELECT student_id, dept_id, CASE WHEN status = 'withdrawn' THEN 'returned' ELSE status END AS status FROM student WHERE status <> 'leave')"""


def merge_sides(c: Campus):
    rows = c.student.select("student_id", "dept_id", "status")
    back = F.when(F.col("status") == "withdrawn", "returned").otherwise(F.col("status"))
    return rows.filter("status <> 'graduated'"), rows.filter("status <> 'leave'").withColumn("status", back)


@query("K10 J09", f"WITH {MERGE} SELECT * FROM s UNION ALL SELECT * FROM t WHERE student_id NOT IN (SELECT student_id FROM s)", "student")
def k10_merge_upsert(c: Campus):
    return tables.merge_upsert(*merge_sides(c), ["student_id"])


@query("K11", "SELECT student_id, email FROM student WHERE email IS NULL OR email NOT LIKE '%7@%'", "student")
def k11_delete_where(c: Campus):
    """A NULL test is not true, so the row stays."""
    return tables.delete_where(c.student.select("student_id", "email"), F.col("email").like("%7@%"))


@query("K12", f"""WITH {MERGE} SELECT * FROM s WHERE status <> 'returned'
    UNION ALL SELECT * FROM t WHERE student_id NOT IN (SELECT student_id FROM s)""", "student")
def k12_merge_with_delete(c: Campus):
    return tables.merge_upsert(*merge_sides(c), ["student_id"], F.col("status") == "returned")


def _seeded(c: Campus, rows, key: str) -> tables.VersionedTable:
    """A versioned table of the rows, in files that each hold a range of keys."""
    target = tables.VersionedTable(c.spark, scratch_path(c.spark, "versions"))
    target.commit(rows.repartitionByRange(16, key), "SEED")
    return target


@query("K10 C08", f"WITH {MERGE} SELECT * FROM s UNION ALL SELECT * FROM t WHERE student_id NOT IN (SELECT student_id FROM s)", "student")
def k10_pruned_merge(c: Campus):
    """The upsert on a stored target: only files that hold a key of the source are written again."""
    rows, source = merge_sides(c)
    target = _seeded(c, rows, "student_id")
    target.merge(source, ["student_id"])
    return target.read()


@query("K11 C08", "SELECT student_id, email FROM student WHERE email IS NULL OR email NOT LIKE '%7@%'", "student")
def k11_pruned_delete(c: Campus):
    target = _seeded(c, c.student.select("student_id", "email"), "student_id")
    target.delete(F.col("email").like("%7@%"))
    return target.read()


@query("K12 C08", f"""WITH {MERGE} SELECT * FROM s WHERE status <> 'returned'
    UNION ALL SELECT * FROM t WHERE student_id NOT IN (SELECT student_id FROM s)""", "student")
def k12_pruned_merge_with_delete(c: Campus):
    rows, source = merge_sides(c)
    target = _seeded(c, rows, "student_id")
    target.merge(source, ["student_id"], F.col("status") == "returned")
    return target.read()


@query("K10", """SELECT aid_id, student_id, CASE WHEN aid_type = '2-HIGH' AND amount > 250000 THEN '3-MEDIUM' WHEN aid_type <> '5-LOW' THEN aid_type END AS aid_type,
    CASE WHEN aid_type = '2-HIGH' AND amount > 250000 THEN amount + 1 WHEN aid_type = '5-LOW' AND amount > 250000 THEN 0.0 ELSE amount END AS amount FROM aid""", "aid")
def k10_merge_partitions(c: Campus):
    """Rows that move to another partition, and changes below the NULL partition, which keeps its other rows."""
    path = scratch_path(c.spark, "merge")
    rows = c.aid.select("aid_id", "student_id", "amount", F.when(F.col("aid_type") != "5-LOW", F.col("aid_type")).alias("aid_type"))
    rows.write.partitionBy("aid_type").parquet(path)
    moved = rows.filter("aid_type = '2-HIGH' AND amount > 250000").withColumns({"amount": F.col("amount") + 1, "aid_type": F.lit("3-MEDIUM")})
    emptied = rows.filter("aid_type IS NULL AND amount > 250000").withColumn("amount", F.lit(0.0))
    return tables.merge_partitions(path, moved.unionByName(emptied), ["aid_id"], "aid_type")


@query("K13", "SELECT count(*) AS source_rows, count(*) AS copy_rows, true AS same_columns FROM aid", "aid")
def k13_copy_gate(c: Campus):
    return tables.copy_table(c.aid, scratch_path(c.spark, "copy"))[1]


@query("K15", "SELECT dept_id, term_id, count(*) AS enrollments FROM history GROUP BY 1, 2", "history")
def k15_report_view(c: Campus):
    stem = uuid4().hex
    tables.write_table(c.history.select("dept_id", "term_id"), f"lakeloom_{stem}", scratch_path(c.spark, "fact"))
    tables.create_views(c.spark, {f"lakeloom_view_{stem}": f"SELECT dept_id, term_id, count(*) AS enrollments FROM lakeloom_{stem} GROUP BY dept_id, term_id"})
    return c.spark.table(f"lakeloom_view_{stem}")


@query("K16", "SELECT 'history' AS job, count(*) AS row_count FROM history UNION ALL SELECT 'student', (SELECT count(*) FROM student)", "history student")
def k16_recorded_metrics(c: Campus):
    path = scratch_path(c.spark, "metrics")
    for job, df in {"history": c.history, "student": c.student}.items():
        rows = tables.record_metrics(c.spark, {"job": job, "row_count": df.count()}, path)
    return rows


TARGET = """t0 AS (SELECT student_id, dept_id, status FROM student WHERE status = 'active'),
    t1 AS (SELECT student_id, dept_id, status FROM student),
    t2 AS (SELECT * FROM t1 WHERE status <> 'withdrawn')"""


@query("X09 K10 K11 C08", f"""WITH {TARGET} SELECT 0::INTEGER AS version, 'SEED' AS operation, count(*) AS row_count FROM t0
    UNION ALL SELECT 1, 'MERGE', count(*) FROM t1 UNION ALL SELECT 2, 'DELETE', count(*) FROM t2""", "student")
def x09_target_history(c: Campus):
    return _load_target(c).history().select("version", "operation", "row_count")


def _load_target(c: Campus) -> tables.VersionedTable:
    target = tables.VersionedTable(c.spark, scratch_path(c.spark, "target"))
    rows = c.student.select("student_id", "dept_id", "status")
    target.commit(rows.filter("status = 'active'"), "SEED")
    target.merge(rows, ["student_id"])
    target.delete(F.col("status") == "withdrawn")
    return target


@query("X09 K04 K05 K07 K09", f"""WITH {TARGET} SELECT f AS format, count(*) AS n, sum(student_id)::BIGINT AS checksum FROM t2,
    (SELECT unnest(['csv', 'json', 'pipe', 'xlsx']) AS f) GROUP BY 1""", "student")
def x09_target_exports(c: Campus):
    """The loaded target exported in four formats, each read back and totalled."""
    rows, base = _load_target(c).read(), scratch_path(c.spark, "exports")
    shape = "student_id long, dept_id long, status string"
    out.export_delimited(rows, f"{base}/csv")
    out.export_delimited(rows, f"{base}/pipe", sep="|")
    out.export_json(rows, f"{base}/json")
    workbook.export_workbooks(rows, f"{base}/xlsx", "Students", "status")
    back = {"csv": files.read_delimited(c.spark, f"{base}/csv", schema=shape),
            "pipe": files.read_delimited(c.spark, f"{base}/pipe", sep="|", schema=shape),
            "json": files.read_json(c.spark, f"{base}/json", schema=shape),
            "xlsx": workbook.read_workbooks(c.spark, f"{base}/xlsx", "Students", rows.schema)}
    return aggregates.labelled({k: df.agg(F.count("*").alias("n"), F.sum("student_id").alias("checksum")) for k, df in back.items()}, "format")


# -- C: change capture ------------------------------------------------------------------

KEYS = ["account_id"]
DIFF = """a AS (SELECT * FROM snaps WHERE v = 1), b AS (SELECT * FROM snaps WHERE v = 2),
    d AS (SELECT coalesce(a.account_id, b.account_id) AS account_id, CASE WHEN a.account_id IS NULL THEN 'insert' WHEN b.account_id IS NULL THEN 'delete'
      ELSE 'update' END AS change, a.level AS old_level, a.status AS old_status, b.level AS new_level, b.status AS new_status
      FROM a FULL JOIN b ON a.account_id = b.account_id WHERE a.account_id IS NULL OR b.account_id IS NULL OR a.level <> b.level OR a.status <> b.status)"""


@query("C01 J17", f"WITH {DIFF} SELECT * FROM d", "snaps")
def c01_snapshot_diff(c: Campus):
    changes = cdc.diff_snapshots(c.snapshot(1), c.snapshot(2), KEYS)
    return changes.select("account_id", "change", F.col("old.level").alias("old_level"), F.col("old.status").alias("old_status"),
                          F.col("new.level").alias("new_level"), F.col("new.status").alias("new_status"))


@query("C02", f"""WITH {DIFF} SELECT account_id, old_level AS level, old_status AS status, CASE change WHEN 'delete' THEN 'delete' ELSE 'update_preimage' END AS _change_type,
      2::INTEGER AS _version FROM d WHERE change IN ('delete', 'update')
    UNION ALL SELECT account_id, new_level, new_status, CASE change WHEN 'insert' THEN 'insert' ELSE 'update_postimage' END, 2 FROM d WHERE change IN ('insert', 'update')""", "snaps")
def c02_change_log(c: Campus):
    return cdc.change_log(c.snapshot(1), c.snapshot(2), KEYS, 2)


FEED = """WITH s AS (SELECT * FROM snaps WHERE v = 1), u AS (SELECT * FROM snaps WHERE v = 2),
    m AS (SELECT u.account_id, s.account_id IS NULL AS fresh, s.level AS old_level, s.status AS old_status, u.level, u.status FROM u LEFT JOIN s ON u.account_id = s.account_id),
    after AS (SELECT account_id, level, status FROM u UNION ALL SELECT account_id, level, status FROM s WHERE account_id NOT IN (SELECT account_id FROM u))
    SELECT account_id, level, status, 'insert' AS _change_type, 1::INTEGER AS _version FROM m WHERE fresh
    UNION ALL SELECT account_id, old_level, old_status, 'update_preimage', 1 FROM m WHERE NOT fresh AND (old_level <> level OR old_status <> status)
    UNION ALL SELECT account_id, level, status, 'update_postimage', 1 FROM m WHERE NOT fresh AND (old_level <> level OR old_status <> status)
    UNION ALL SELECT account_id, level, status, 'delete', 2 FROM after WHERE account_id LIKE '%3-%'"""


@query("C02 K10 K11 C08", FEED, "snaps")
def c02_change_feed(c: Campus):
    """Changes of versions 1 to 2 of a stored table, an upsert and a delete, as their commits wrote them."""
    target = _seeded(c, c.snapshot(1), "account_id")
    target.merge(c.snapshot(2), KEYS)
    target.delete(F.col("account_id").like("%3-%"))
    return target.changes(1, 2)


@query("C03", "SELECT account_id, level, status FROM snaps WHERE v = 3", "snaps")
def c03_scd1(c: Campus):
    state = cdc.scd1(c.snapshot(1), c.snapshot(2), KEYS)
    return cdc.scd1(durable(state, "scd1"), c.snapshot(3), KEYS)


SCD2 = """WITH s AS (SELECT *, lag(v) OVER w AS pv, lag(level) OVER w AS pl, lag(status) OVER w AS ps FROM snaps WINDOW w AS (PARTITION BY account_id ORDER BY v)),
    g AS (SELECT *, sum(CASE WHEN pv = v - 1 AND pl = level AND ps = status THEN 0 ELSE 1 END) OVER (PARTITION BY account_id ORDER BY v) AS grp FROM s)
    SELECT account_id, level, status, min(v)::INTEGER AS __START_AT, CASE WHEN max(v) < 3 THEN (max(v) + 1)::INTEGER END AS __END_AT FROM g GROUP BY account_id, level, status, grp"""


@query("C04", SCD2, "snaps")
def c04_scd2(c: Campus):
    """Version by version, as a daily job runs."""
    first = cdc.scd2(cdc.scd2_start(c.snapshot(1), 1), c.snapshot(2), 2, KEYS)
    return cdc.scd2(durable(first, "scd2"), c.snapshot(3), 3, KEYS)


@query("C04", SCD2, "snaps")
def c04_scd2_backfill(c: Campus):
    """All versions in one pass."""
    return cdc.scd2_from([(c.snapshot(v), v) for v in (1, 2, 3)], KEYS)


@query("C05 C04", SCD2, "snaps")
def c05_snapshot_feed(c: Campus):
    """The feed hands out versions until none is newer than the target."""
    feed = cdc.SnapshotFeed({v: c.snapshot(v) for v in (3, 1, 2)})
    target = tables.VersionedTable(c.spark, scratch_path(c.spark, "feed"))
    done, step = None, feed.next(None)
    while step is not None:
        done = stream_cdc.apply_snapshot(target, step[0], step[1], KEYS, 2)
        step = feed.next(done)
    return target.read()


def _streamed_snapshots(c: Campus, kind: int):
    """Snapshots arrive as files, the second one in two drops; replaying the stream changes nothing."""
    work = scratch_path(c.spark, "snaps")
    half = F.pmod(F.xxhash64("account_id"), F.lit(2))
    drops = [[(1, F.lit(True), True)], [(2, half == 0, True)], [(2, half == 1, False), (3, F.lit(True), True)], []]
    for drop in drops:
        for v, part, closes in drop:
            rows = c.snapshot(v)
            rows.filter(part).withColumn("snapshot_version", F.lit(v)).write.mode("append").parquet(f"{work}/in")
            if closes:
                stream_cdc.announce(c.spark, f"{work}/in", v, rows.count())
        schema = c.snapshot(1).schema.add("snapshot_version", IntegerType())
        target = stream_cdc.stream_snapshots(c.spark, f"{work}/in", schema, f"{work}/checkpoint", f"{work}/target", KEYS, kind)
    return target.read()


@query("R04 C04", SCD2, "snaps")
def r04_streamed_scd2(c: Campus):
    return _streamed_snapshots(c, 2)


@query("R04 C03", "SELECT account_id, level, status FROM snaps WHERE v = 3", "snaps")
def r04_streamed_scd1(c: Campus):
    return _streamed_snapshots(c, 1)


@query("C06 L03 U03", """WITH gone AS (SELECT student_id FROM student ORDER BY student_id DESC LIMIT 5), kept AS (SELECT student_id, dept_id, status FROM student WHERE student_id NOT IN (SELECT student_id FROM gone)),
    flip AS (SELECT student_id FROM kept ORDER BY student_id LIMIT 20)
    SELECT student_id, dept_id, CASE WHEN student_id IN (SELECT student_id FROM flip) THEN 'graduated' ELSE status END AS status FROM kept
    UNION ALL SELECT student_id + 900000000, dept_id, 'active' FROM (SELECT * FROM student ORDER BY student_id LIMIT 10)""", "student")
def c06_planted_changes(c: Campus):
    return cdc.plant_changes(c.student.select("student_id", "dept_id", "status"), "student_id", 10, 20, 5, 900000000)


@query("C07 C08", """SELECT 1::INTEGER AS version, 'loyalty' AS column_name, 'add' AS change, NULL::VARCHAR AS old_type, 'int' AS new_type, count(*) AS row_count FROM student
    UNION ALL SELECT 2, 'loyalty', 'retype', 'int', 'bigint', count(*) FROM student UNION ALL SELECT 2, 'status', 'drop', 'string', NULL, count(*) FROM student""", "student")
def c07_schema_history(c: Campus):
    target = tables.VersionedTable(c.spark, scratch_path(c.spark, "drift"))
    rows = c.student.select("student_id", "dept_id", "status")
    target.commit(rows, "CREATE")
    target.commit(rows.withColumn("loyalty", F.lit(0)), "ADD COLUMN")
    target.commit(rows.drop("status").withColumn("loyalty", F.lit(0).cast("long")), "REPLACE")
    return target.schema_history().join(target.history().select("version", "row_count"), "version").drop("user_name", "at")


# -- M: learning ------------------------------------------------------------------------

FEATURES = """train AS (SELECT enrollment_id, student_id, course_id, term_id, h.dept_id, t.year AS term_year, t.season AS term_season, s.status AS student_status,
    (2024 - year(born))::INTEGER AS age, grade AS label FROM history h JOIN (SELECT student_id, status, born FROM student) s USING (student_id)
    JOIN (SELECT term_id, year, season FROM term) t USING (term_id))"""
NUMERIC = ["course_id", "term_id", "dept_id", "term_year", "age"]
CATEGORICAL = ["term_season", "student_status"]


def training(c: Campus):
    return learning.training_set(c.history, c.student, c.term, "2024-09-01")


@query("M01", f"WITH {FEATURES} SELECT * FROM train", "history student term")
def m01_training_set(c: Campus):
    return training(c)


def enrollment_split(c: Campus):
    rows = learning.training_set(
        c.enrollment.join(c.student.select("student_id", "dept_id"), "student_id"), c.student, c.term, "2024-09-01")
    return learning.stratified_split(rows, "label", ["enrollment_id"])


@query("M03", """WITH r AS (SELECT enrollment_id, grade, row_number() OVER (PARTITION BY grade ORDER BY md5(enrollment_id::VARCHAR), enrollment_id) AS rn,
    count(*) OVER (PARTITION BY grade) AS n FROM enrollment) SELECT enrollment_id, grade AS label, rn <= floor(n * 0.8::DOUBLE) AS is_train FROM r""", "enrollment")
def m03_stratified_split(c: Campus):
    return enrollment_split(c).select("enrollment_id", "label", "is_train")


@query("M05", "SELECT round(max(n)::DOUBLE / sum(n)::BIGINT, 6) AS majority_rate, sum(n)::BIGINT AS total FROM (SELECT count(*) AS n FROM history GROUP BY grade)", "history")
def m05_majority_baseline(c: Campus):
    return learning.majority_rate(c.history, "grade")


def scored(c: Campus):
    """The scored test rows, written once: no later step, and no caller that reads a result twice, runs the forest again."""
    split = learning.dealt(enrollment_split(c), ["enrollment_id", "student_id", "course_id"])
    pipeline = learning.forest(NUMERIC, CATEGORICAL, "label")
    model = learning.train_and_save(split.filter("is_train"), scratch_path(c.spark, "model"), pipeline, NUMERIC)
    test = learning.score(model, split.filter("NOT is_train"), NUMERIC)
    return durable(test.select("label", "label_ix", "prediction", "predicted"), "scored")


TEST_ROWS = """test AS (SELECT grade AS label FROM (SELECT enrollment_id, grade, row_number() OVER (PARTITION BY grade ORDER BY md5(enrollment_id::VARCHAR), enrollment_id) AS rn,
    count(*) OVER (PARTITION BY grade) AS n FROM enrollment) WHERE rn > floor(n * 0.8::DOUBLE))"""


@query("M04 M05", f"""WITH {TEST_ROWS} SELECT round(max(n)::DOUBLE / sum(n)::BIGINT, 6) AS majority_rate, sum(n)::BIGINT AS total, true AS no_leak
    FROM (SELECT count(*) AS n FROM test GROUP BY label)""", "enrollment")
def m04_forest_scores(c: Campus):
    """The majority baseline of the test rows, and the gate that accuracy is not too good to be true.

    What depends on the trees, which SQL cannot state, is in ``m04_forest_gates``.
    """
    test = scored(c)
    accuracy = F.lit(learning.metrics(test)["accuracy"])
    return learning.majority_rate(test, "label").select(
        "majority_rate", "total", (accuracy < 0.99).alias("no_leak"))


@query("M06", f"WITH {TEST_ROWS} SELECT label AS actual, count(*) AS test_rows, true AS known_labels FROM test GROUP BY label", "enrollment")
def m06_confusion(c: Campus):
    """All pairs of actual and predicted label, added up per actual one: every test row is in one pair (the pairs: ``m06_confusion_pairs``)."""
    pairs = learning.confusion(scored(c), n=None)
    return pairs.groupBy("actual").agg(F.sum("n").alias("test_rows"), F.bool_and(F.col("predicted").isNotNull()).alias("known_labels"))


@query("M04 M05")
def m04_forest_gates(c: Campus):
    """Accuracy, weighted F1 and majority baseline of the test rows, and both gates; they depend on the trees, so no SQL states them."""
    return learning.gates(scored(c).select("label", "label_ix", "prediction"), "label")


@query("M06")
def m06_confusion_pairs(c: Campus):
    """How often each actual label is predicted as which; the pairs depend on the trees, so no SQL states them."""
    return learning.confusion(scored(c), n=None)


@query("M02", """SELECT c AS column_name, v AS category, (row_number() OVER (PARTITION BY c ORDER BY v) - 1)::INTEGER AS position FROM (
    SELECT DISTINCT 'term_season' AS c, season AS v FROM enrollment JOIN (SELECT term_id, season FROM term) USING (term_id)
    UNION SELECT DISTINCT 'student_status', status FROM enrollment JOIN (SELECT student_id, status FROM student) USING (student_id)
    UNION SELECT DISTINCT 'label', grade FROM enrollment)""", "enrollment student term")
def m02_category_lists(c: Campus):
    """The categories that the fitted indexers hold, in order."""
    pipeline = learning.forest(NUMERIC, CATEGORICAL, "label", trees=1, depth=1)
    model = learning.train_and_save(enrollment_split(c).filter("is_train"), scratch_path(c.spark, "model"), pipeline, NUMERIC)
    rows = [(col, v, k) for col, values in zip([*CATEGORICAL, "label"], model.stages[0].labelsArray, strict=True) for k, v in enumerate(values)]
    return c.spark.createDataFrame(rows, "column_name string, category string, position int")
