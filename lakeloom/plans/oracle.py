"""The same entities as DuckDB table expressions, to check queries against."""

from __future__ import annotations

from lakeloom.functions import fixed


def case_in(col: str, labels: dict[str, list[str]], other: str) -> str:
    """CASE giving the label whose list holds the value."""
    whens = " ".join("WHEN {} IN ({}) THEN '{}'".format(col, ", ".join(f"'{v}'" for v in vs), k) for k, vs in labels.items())
    return f"CASE {whens} ELSE '{other}' END"


def case_below(col: str, steps: list[tuple[float, str]], last: str) -> str:
    """CASE giving the label of the first upper bound above the value."""
    return "CASE " + " ".join(f"WHEN {col} < {b} THEN '{k}'" for b, k in steps) + f" ELSE '{last}' END"


def case_band(col: str, order: bool = False) -> str:
    """CASE giving the band of a value, or its position."""
    names = [k for _, k in fixed.POINT_BANDS] + [fixed.LOWEST_BAND, fixed.NULL_BAND]
    out = [str(i) for i in range(1, len(names) + 1)] if order else [f"'{k}'" for k in names]
    whens = " ".join(f"WHEN {col} >= {b} THEN {o}" for (b, _), o in zip(fixed.POINT_BANDS, out))
    return f"CASE WHEN {col} IS NULL THEN {out[-1]} {whens} ELSE {out[-2]} END"


def list_of(values) -> str:
    return "[" + ", ".join("NULL" if v is None else repr(v) for v in values) + "]"


STANDING = case_in("status", {v: [k] for k, v in fixed.STANDING.items()}, fixed.OTHER_STANDING)
TIER = case_below("total_duration_ms", fixed.TIERS, fixed.LAST_TIER)
BUCKET = case_below("total_duration_ms", fixed.BUCKETS, fixed.LAST_BUCKET)
STATUS = case_in("raw_state", fixed.RUN_STATUS, "Other")

_TERM = "((year({d}) - 1995) * 3 + (month({d}) - 1) // 4 + 1)::BIGINT"
_GRADE = "(" + list_of(fixed.GRADE_POINTS) + ")[{i} + 1]"
_POINTS = "(" + list_of(fixed.GRADE_POINTS.values()) + "::DOUBLE[])[{i} + 1]"
_EMAIL = ("CASE WHEN user_id % 10 = 0 THEN printf('%08x-0000-4000-8000-%012x', user_id, user_id) "
          "ELSE 'user' || user_id || '@campus.example' END")

ENTITIES: dict[str, tuple[tuple[str, ...], str]] = {
    "department": ((), "SELECT n_nationkey::BIGINT AS dept_id, n_name AS name, r_name AS division "
                       "FROM nation JOIN region ON n_regionkey = r_regionkey"),
    "term": ((), """SELECT ((y - 1995) * 3 + t + 1)::BIGINT AS term_id, y::INTEGER AS year,
        (['Spring','Summer','Fall'])[t + 1] AS season, make_date(y, t * 4 + 1, 1) AS start_date,
        last_day(make_date(y, t * 4 + 4, 1)) AS end_date
        FROM (SELECT DISTINCT year(o_orderdate) AS y, (month(o_orderdate) - 1) // 4 AS t FROM orders)"""),
    "student": ((), """SELECT c_custkey AS student_id,
        CASE WHEN c_custkey % 5 = 0 THEN upper(c_mktsegment) ELSE lower(c_mktsegment) END AS first_name,
        c_name AS last_name,
        printf('%03d-%02d-%04d', 900 + c_custkey % 100, (c_custkey // 100) % 100, (c_custkey // 10000) % 10000) AS ssn,
        CASE c_custkey % 3 WHEN 0 THEN strftime(DATE '1995-01-01' + (c_custkey * 7 % 4745)::INTEGER, '%Y-%m-%d')
          WHEN 1 THEN strftime(DATE '1995-01-01' + (c_custkey * 7 % 4745)::INTEGER, '%m/%d/%Y')
          ELSE strftime(DATE '1995-01-01' + (c_custkey * 7 % 4745)::INTEGER, '%d.%m.%Y') END AS dob,
        DATE '1995-01-01' + (c_custkey * 7 % 4745)::INTEGER AS born,
        c_nationkey::BIGINT AS dept_id,
        CASE WHEN c_custkey % 20 = 0 THEN 'leave' WHEN c_mktsegment = 'HOUSEHOLD' THEN 'graduated'
          WHEN c_mktsegment = 'FURNITURE' THEN 'withdrawn' ELSE 'active' END AS status,
        CASE WHEN c_custkey % 50 <> 0 THEN 'student' || c_custkey || '@campus.example' END AS email FROM customer"""),
    "faculty": ((), """SELECT s_suppkey AS faculty_id, s_name AS name,
        printf('%03d-%02d-%04d', 950 + s_suppkey % 50, (s_suppkey // 50) % 100, (s_suppkey // 5000) % 10000) AS ssn,
        s_nationkey::BIGINT AS dept_id,
        CASE WHEN s_acctbal >= 6000 THEN 'Professor' WHEN s_acctbal >= 3000 THEN 'Associate' ELSE 'Assistant' END AS rank
        FROM supplier"""),
    "course": ((), """SELECT p_partkey AS course_id, p_partkey % 25 AS dept_id,
        p_partkey % (SELECT count(*) FROM supplier) AS faculty_id, p_name AS title,
        (p_size % 4 + 1)::INTEGER AS credits FROM part"""),
    "enrollment": ((), f"""SELECT o_orderkey AS enrollment_id, o_custkey AS student_id,
        o_orderkey % (SELECT count(*) FROM part) AS course_id, {_TERM.format(d='o_orderdate')} AS term_id,
        {_GRADE.format(i='o_orderkey % 10')} AS grade, {_POINTS.format(i='o_orderkey % 10')} AS gpa_points FROM orders"""),
    "history": ((), f"""SELECT l_orderkey AS enrollment_id, o_custkey AS student_id, l_partkey AS course_id,
        {_TERM.format(d='o_orderdate')} AS term_id, c_nationkey::BIGINT AS dept_id,
        {_GRADE.format(i='floor((l_quantity - 1) / 5)::INTEGER')} AS grade,
        {_POINTS.format(i='floor((l_quantity - 1) / 5)::INTEGER')} AS gpa_points, l_shipdate AS load_ts
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"""),
    "aid": ((), f"""SELECT o_orderkey AS aid_id, o_custkey AS student_id, o_totalprice AS amount,
        o_orderpriority AS aid_type, {_TERM.format(d='o_orderdate')} AS term_id FROM orders"""),
    "budget": (("department",), "SELECT dept_id, name AS dept_name, 500000 + dept_id * 25000 AS budget_amount, "
                                "DATE '2024-07-01' AS approved_date FROM department"),
    "ev": ((), "SELECT *, regexp_extract(props, '\"k\": *([0-9]+)', 1)::INTEGER AS k FROM events"),
    "query_history": (("ev",), """SELECT event_id AS statement_id, 'user' || user_id AS executed_by,
        'wh_' || (k % 5) AS warehouse_id, ts AS start_time,
        ts + to_milliseconds(round(value * 20)::BIGINT) AS end_time, round(value * 20)::BIGINT AS total_duration_ms,
        round(greatest(value - 200, 0) * 100)::BIGINT AS waiting_ms, (k * 10)::BIGINT AS read_rows,
        CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'CANCELED' ELSE 'FINISHED' END AS execution_status,
        'SELECT  *   FROM ' || event_type || '_log  WHERE k = ' || k AS statement_text,
        CASE WHEN k < 50 THEN 'nb_' || (k % 10) END AS notebook_id FROM ev"""),
    "job_periods": (("ev",), """SELECT user_id AS job_id, user_id || '_' || ts::DATE AS run_id, event_type AS task_key,
        ts AS period_start, ts + to_microseconds(round(value * 1000000)::BIGINT) AS period_end,
        CASE WHEN event_type IN ('click', 'purchase') THEN 'SUCCEEDED' WHEN event_type = 'error' THEN 'FAILED'
          WHEN event_type = 'signup' THEN 'CANCELED' END AS result_state FROM ev"""),
    "jobs": (("ev",), """SELECT user_id AS job_id, 'job_' || user_id || '_' || (k % 7) AS name, ts AS change_time,
        CASE WHEN k >= 95 THEN ts + INTERVAL 1 HOUR END AS delete_time FROM ev WHERE event_type = 'signup'"""),
    "job_names": (("jobs",), """SELECT job_id, name FROM jobs WHERE delete_time IS NULL
        QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY change_time DESC, name DESC) = 1"""),
    "pipeline_periods": ((), """SELECT l_suppkey AS pipeline_id, l_orderkey AS update_id, l_shipdate AS period_start,
        l_shipdate + to_minutes(l_quantity::BIGINT) AS period_end,
        CASE l_returnflag WHEN 'R' THEN 'FAILED' WHEN 'A' THEN 'COMPLETED' END AS result_state FROM lineitem"""),
    "pipelines": ((), "SELECT s_suppkey AS pipeline_id, s_name AS name FROM supplier WHERE NOT s_acctbal < 500"),
    "runs": (("job_periods", "job_names", "pipeline_periods", "pipelines", "query_history"), f"SELECT *, {STATUS} AS status," + r"""
          (epoch(date_trunc('second', end_time)) - epoch(date_trunc('second', start_time)))::BIGINT AS secs
        FROM (
          SELECT 'Job' AS workload_type, name, run_id, min(period_start) AS start_time, max(period_end) AS end_time,
            max(result_state) AS raw_state FROM job_periods JOIN job_names USING (job_id) GROUP BY ALL
          UNION ALL
          SELECT 'Pipeline', name, update_id::VARCHAR, min(period_start), max(period_end), max(result_state)
            FROM pipeline_periods JOIN pipelines USING (pipeline_id) GROUP BY pipeline_id, name, update_id
          UNION ALL
          SELECT 'Notebook', 'Notebook: ' || substr(regexp_replace(statement_text, '\s+', ' ', 'g'), 1, 40),
            statement_id::VARCHAR, start_time, end_time, execution_status FROM query_history WHERE notebook_id IS NOT NULL)
        WHERE raw_state IS NOT NULL"""),
    "warehouse_events": (("ev",), """SELECT 'wh_' || (k % 5) AS warehouse_id,
        CASE event_type WHEN 'signup' THEN 'SCALED_UP' WHEN 'purchase' THEN 'SCALED_DOWN' ELSE 'RUNNING' END AS event_type,
        1 + k % 8 AS cluster_count, ts AS event_time FROM ev"""),
    "audit": (("ev",), f"""SELECT ts AS event_time, ts::DATE AS event_date, {_EMAIL} AS email,
        CASE WHEN event_type IN ('click','purchase') THEN 'notebook' WHEN event_type = 'view' THEN 'accounts'
          ELSE 'catalog' END AS service_name,
        CASE WHEN event_type = 'click' THEN 'openNotebook' WHEN event_type = 'purchase' THEN 'modifyNotebook'
          WHEN event_type = 'signup' THEN 'updatePermissions'
          WHEN event_type = 'view' AND k < 10 THEN 'rotateServicePrincipalSecret' ELSE 'getTable' END AS action_name,
        'lake.' || CASE WHEN (k // 4) % 2 = 0 THEN 'silver' ELSE 'sandbox' END || '.' ||
          (['student','faculty','financial_aid','enrollment'])[k % 4 + 1] AS securable,
        '[{{"principal":"user' || k || '","add":["SELECT"]}}]' AS changes,
        CASE WHEN event_type = 'error' AND k < 60 THEN 'Permission_Denied: no SELECT'
          WHEN event_type = 'error' THEN 'TIMEOUT' END AS error_message, k FROM ev"""),
    "reads": (("audit",), "SELECT securable AS source_table, email AS created_by, event_time, event_date FROM audit "
                          "WHERE action_name IN ('getTable', 'openNotebook')"),
    "grants": (("audit",), """SELECT DISTINCT email AS grantee,
        (['catalog','schema','table','function'])[k % 4 + 1] AS scope,
        CASE k % 4 WHEN 0 THEN 'lake' WHEN 3 THEN 'lake.sandbox.mask_partial' ELSE
          'lake.' || CASE WHEN (k // 4) % 2 = 0 THEN 'silver' ELSE 'sandbox' END ||
          CASE WHEN k % 4 = 2 THEN '.financial_aid' ELSE '' END END AS object_name,
        CASE WHEN k % 4 = 3 THEN CASE WHEN (k // 8) % 2 = 0 THEN 'EXECUTE' ELSE 'OWN' END
          ELSE (['SELECT','MODIFY','USE'])[(k // 8) % 3 + 1] END AS privilege_type
        FROM audit WHERE action_name = 'updatePermissions'"""),
    "usage": ((), """SELECT p_brand AS sku_name, p_type AS product, l_quantity AS quantity, l_shipdate AS usage_end,
        l_shipdate::DATE AS usage_date, l_orderkey AS order_id FROM lineitem JOIN part ON l_partkey = p_partkey"""),
    "prices": ((), """SELECT sku_name, make_date(y, 1, 1)::TIMESTAMP AS price_start,
        CASE WHEN y < 2001 THEN make_date(y + 1, 1, 1)::TIMESTAMP END AS price_end,
        round((100 + substr(sku_name, 7)::INTEGER * 10 + (y - 1995) * 5) / 100.0::DOUBLE, 2) AS price
        FROM (SELECT DISTINCT p_brand AS sku_name FROM part WHERE p_brand <> 'Brand#25') b,
          (SELECT unnest(range(1995, 2002)) AS y) yy"""),
    "costs": (("usage", "prices"), """SELECT u.*, p.price, u.quantity * p.price AS cost FROM usage u
        LEFT JOIN prices p ON u.sku_name = p.sku_name AND u.usage_end >= p.price_start
          AND (p.price_end IS NULL OR u.usage_end < p.price_end)"""),
    "access": (("faculty", "department"), """SELECT name AS principal, dept_id FROM faculty
        UNION ALL SELECT 'division:' || division, dept_id FROM department"""),
    "memberships": (("department",), """SELECT s_name AS principal, 'division:' || division AS group_name
        FROM supplier JOIN department ON s_nationkey = dept_id WHERE s_acctbal > 5000
        UNION ALL SELECT s_name, 'admins' FROM supplier WHERE s_acctbal >= 9000"""),
    "allowed": (("access", "memberships"), """SELECT DISTINCT u.principal, a.dept_id FROM (
          SELECT principal, group_name AS identity FROM memberships
          UNION SELECT name, name FROM faculty) u JOIN access a ON a.principal = u.identity"""),
    "lineage": ((), """SELECT DISTINCT 'raw.s' || l_suppkey AS source_table, 'silver.p' || l_partkey AS target_table FROM lineitem
        UNION SELECT 'silver.p' || p_partkey, 'gold.' || p_brand FROM part
        UNION SELECT 'gold.' || p_brand, 'report.' || p_type FROM part"""),
    "snaps": ((), """SELECT v, user_id || '-' || event_type AS account_id, floor(max(value) / 100)::INTEGER AS level,
        CASE WHEN max(value) >= 50 THEN 'active' ELSE 'dormant' END AS status
        FROM (SELECT *, CASE WHEN ts < TIMESTAMP '2024-01-11' THEN 1 WHEN ts < TIMESTAMP '2024-01-21' THEN 2 ELSE 3 END AS v
              FROM events WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-02-01')
        GROUP BY v, user_id, event_type"""),
}


def oracle(needs: str, body: str, recursive: bool = False) -> str:
    """``body`` with the needed entities in front as common table expressions."""
    order: list[str] = []

    def visit(name: str) -> None:
        for dep in ENTITIES[name][0]:
            visit(dep)
        if name not in order:
            order.append(name)

    for name in needs.split():
        visit(name)
    own = body.strip()
    parts = [f"{n} AS ({ENTITIES[n][1]})" for n in order]
    if own.upper().startswith("WITH "):
        own = own[5:]
        joiner = ", " if parts else ""
        return f"WITH {'RECURSIVE ' if recursive else ''}{', '.join(parts)}{joiner}{own}"
    return f"WITH {', '.join(parts)} {own}" if parts else own
