"""Row filters, masks, policy inventory and access audit."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions.masks import MASKS, partial_sql, register_sql_masks
from lakeloom.functions.text import matches_any

ADMIN_GROUP, FACULTY_GROUP, STUDENT_GROUP = "admins", "faculty", "students"


@dataclass
class Policies:
    """Masks per (schema, table, column) and row-filter column per (schema, table)."""

    masks: dict[tuple[str, str, str], str] = field(default_factory=dict)
    filters: dict[tuple[str, str], str] = field(default_factory=dict)

    def mask_rows(self, spark: SparkSession) -> DataFrame:
        rows = [(s, t, c, f"mask_{m}") for (s, t, c), m in sorted(self.masks.items())]
        return spark.createDataFrame(
            rows, "table_schema string, table_name string, column_name string, mask_name string")

    def filter_rows(self, spark: SparkSession) -> DataFrame:
        rows = [(s, t, "filter_by_department", c) for (s, t), c in sorted(self.filters.items())]
        return spark.createDataFrame(
            rows, "table_schema string, table_name string, filter_name string, target_columns string")


def session_principal(spark: SparkSession) -> str:
    """Name of the user running the session, to pass where a principal is asked for."""
    return spark.sql("SELECT current_user()").first()[0]


def identities(memberships: DataFrame, principal: str) -> DataFrame:
    """The principal itself and every group it belongs to."""
    groups = memberships.filter(F.col("principal") == principal).select(F.col("group_name").alias("identity"))
    own = memberships.sparkSession.range(1).select(F.lit(principal).alias("identity"))
    return groups.unionByName(own).distinct()


def is_member(memberships: DataFrame, principal: str, group: str) -> bool:
    """Group membership is data: (principal, group_name) rows."""
    hit = memberships.filter((F.col("principal") == principal) & (F.col("group_name") == group))
    return not hit.limit(1).isEmpty()


def role_of(memberships: DataFrame, principal: str) -> Column:
    """The principal's mask role, from its groups; a subquery, so it is answered whenever a plan runs."""
    groups = memberships.filter(F.col("principal") == principal)
    within = lambda group: F.bool_or(F.col("group_name") == group)
    return groups.agg(F.when(within(ADMIN_GROUP), "admin").when(within(FACULTY_GROUP), "faculty")
                      .when(within(STUDENT_GROUP), "student").otherwise("other")).scalar()


def allowed_values(access: DataFrame, memberships: DataFrame, principal: str, col: str) -> DataFrame:
    """Values mapped to the principal or to one of its groups; empty for an unmapped one."""
    who = identities(memberships, principal)
    return (access.join(who, access["principal"] == who["identity"], "left_semi")
            .select(col).distinct())


def row_filter(
    df: DataFrame, access: DataFrame, memberships: DataFrame, principal: str, col: str = "dept_id",
    self_col: str | None = None,
) -> DataFrame:
    """Admins see all rows, mapped principals their values, everyone else none.

    With ``self_col`` a third tier, students, sees only rows naming the
    principal (G22). Who the principal is gets decided when the plan runs: the
    role is a subquery, the mapped values a join with one row per value.
    """
    role = role_of(memberships, principal)
    mapped = allowed_values(access, memberships, principal, col).select(F.col(col).alias("_mapped"))
    seen = F.col("_mapped").isNotNull()
    if self_col is not None:
        seen = F.when(role == "student", F.col(self_col) == principal).otherwise(seen)
    return (df.join(mapped, F.col(col) == F.col("_mapped"), "left")
            .filter((role == "admin") | F.coalesce(seen, F.lit(False))).select(*df.columns))


def mask_columns(df: DataFrame, masks: dict[str, str], role: Column | str) -> DataFrame:
    """Replace each masked column by its expression, all others unchanged."""
    return df.select(*[MASKS[masks[c]](c, role).alias(c) if c in masks else F.col(c) for c in df.columns])


def secure(
    df: DataFrame, schema: str, table: str, policies: Policies, principal: str,
    access: DataFrame, memberships: DataFrame,
) -> DataFrame:
    """Filter on raw values first, then mask by the role that the memberships give."""
    col = policies.filters.get((schema, table))
    seen = row_filter(df, access, memberships, principal, col) if col else df
    masks = {c: m for (s, t, c), m in policies.masks.items() if (s, t) == (schema, table)}
    return mask_columns(seen, masks, role_of(memberships, principal))


def grant(access: DataFrame, principal: str, dept_id: int, by: str, at: str) -> DataFrame:
    """The mapping with one more row; nothing else changes."""
    row = access.sparkSession.createDataFrame(
        [(principal, dept_id, by, at)], "principal string, dept_id long, granted_by string, granted_at string")
    return access.unionByName(row.withColumn("granted_at", F.col("granted_at").cast("timestamp_ntz")).select(*access.columns))


def visibility_report(
    df: DataFrame, departments: DataFrame, access: DataFrame, memberships: DataFrame, principal: str,
) -> DataFrame:
    """Rows per department and whether the principal sees them."""
    seen = allowed_values(access, memberships, principal, "dept_id").withColumn("_seen", F.lit(True))
    n = df.groupBy("dept_id").agg(F.count("*").alias("students"))
    return (n.join(departments.select("dept_id", F.col("name").alias("department")), "dept_id")
            .join(seen, "dept_id", "left")
            .withColumn("visibility", F.when(F.col("_seen"), "visible").otherwise("filtered out"))
            .drop("_seen"))


def rows_visible(df: DataFrame, access: DataFrame, memberships: DataFrame, col: str = "dept_id") -> DataFrame:
    """Rows each mapped or member principal sees, for all principals at once.

    Rows are counted per value first, so the expansion joins counts, not rows.
    Admins are listed with the full count; unmapped principals with 0.
    """
    people = memberships.select("principal").union(access.select("principal")).distinct()
    groups = memberships.select("group_name").distinct()
    users = people.join(groups, people["principal"] == groups["group_name"], "left_anti")
    who = users.select("principal", F.col("principal").alias("identity")).union(
        memberships.select("principal", F.col("group_name").alias("identity"))).distinct()
    maps = access.select(F.col("principal").alias("identity"), col)
    values = who.join(maps, "identity").select("principal", col).distinct()
    per_value = df.groupBy(col).agg(F.count("*").alias("n"))
    mapped = values.join(per_value, col).groupBy("principal").agg(F.sum("n").alias("_mapped"))
    admins = (memberships.filter(F.col("group_name") == ADMIN_GROUP).select("principal").distinct()
              .withColumn("_admin", F.lit(True)))
    total = df.agg(F.count("*").alias("n")).scalar()
    return (users.join(mapped, "principal", "left").join(admins, "principal", "left")
            .select("principal", F.when(F.col("_admin"), total)
                    .otherwise(F.coalesce("_mapped", F.lit(0))).alias("rows_visible")))


def simulate_roles(df: DataFrame, key: str, col: str, mask: str, roles: list[str]) -> DataFrame:
    """One column per role with what that role would see."""
    return df.select(key, F.col(col).alias("true_value"),
                     *[MASKS[mask](col, r).alias(f"as_{r}") for r in roles])


def column_catalog(spark: SparkSession, tables: dict[tuple[str, str], DataFrame]) -> DataFrame:
    rows = [(s, t, f.name, f.dataType.simpleString())
            for (s, t), df in tables.items() for f in df.schema.fields]
    return spark.createDataFrame(
        rows, "table_schema string, table_name string, column_name string, data_type string")


def coverage_gap(columns: DataFrame, masks: DataFrame, fragments: list[str]) -> DataFrame:
    """Sensitive-looking columns with their mask or UNPROTECTED."""
    looks = columns.filter(matches_any("column_name", fragments))
    joined = looks.join(masks, ["table_schema", "table_name", "column_name"], "left")
    return joined.select("table_schema", "table_name", "column_name", "data_type",
                         F.coalesce("mask_name", F.lit("UNPROTECTED")).alias("mask_status"))


def exposed_values(tables: dict[tuple[str, str], DataFrame], fragments: list[str]) -> DataFrame:
    """Non-null values per sensitive-looking column, one scan per table."""
    out = None
    for (schema, table), df in tables.items():
        cols = [c for c in df.columns if any(f in c.lower() for f in fragments)]
        if not cols:
            continue
        n = df.agg(*[F.count(c).alias(c) for c in cols]).unpivot([], cols, "column_name", "exposed_values")
        part = n.select(F.lit(schema).alias("table_schema"), F.lit(table).alias("table_name"),
                        "column_name", "exposed_values")
        out = part if out is None else out.unionByName(part)
    return out


def policy_leaks(masks: DataFrame, filters: DataFrame, sandbox: str) -> DataFrame:
    """Policies attached outside the sandbox schema."""
    both = masks.select("table_schema", "table_name", F.lit("mask").alias("kind")).unionByName(
        filters.select("table_schema", "table_name", F.lit("filter").alias("kind")))
    return both.filter(F.col("table_schema") != sandbox)


def privileges(grants: DataFrame, scope: str | None = None) -> DataFrame:
    """Who holds what, most specific columns last."""
    held = grants if scope is None else grants.filter(F.col("scope") == scope)
    return held.select("grantee", "scope", "object_name", "privilege_type").distinct()


def can_rewrite(grants: DataFrame, privileges_: tuple[str, ...] = ("EXECUTE", "MODIFY", "OWN")) -> DataFrame:
    """Principals whose privileges on policy functions let them change a policy."""
    return (grants.filter((F.col("scope") == "function") & F.col("privilege_type").isin(*privileges_))
            .select("grantee", "object_name", "privilege_type").distinct())


def least_privilege(grants: DataFrame, schema: str) -> DataFrame:
    """Grantees with a table-level SELECT and whether they also read the whole schema."""
    select = grants.filter(F.col("privilege_type") == "SELECT")
    narrow = (select.filter((F.col("scope") == "table") & F.col("object_name").startswith(schema + "."))
              .groupBy("grantee").agg(F.countDistinct("object_name").alias("tables")))
    wide = (select.filter((F.col("scope") == "schema") & (F.col("object_name") == schema))
            .select("grantee").distinct().withColumn("_wide", F.lit(True)))
    return narrow.join(wide, "grantee", "left").select(
        "grantee", "tables", F.col("_wide").isNull().alias("passed"))


def audit_window(log: DataFrame, as_of: str, days: int) -> DataFrame:
    """Partition-date filter that every audit query starts from (P10)."""
    return log.filter(F.col("event_date").between(
        F.date_sub(F.lit(as_of).cast("date"), days), F.lit(as_of).cast("date")))


def permission_changes(log: DataFrame, as_of: str, days: int, prefix: str | None = None) -> DataFrame:
    """Who changed which permission and when, optionally below a name prefix."""
    hit = audit_window(log, as_of, days).filter(F.col("action_name") == "updatePermissions")
    rows = hit.select("event_time", F.col("user_identity.email").alias("actor"),
                      F.col("request_params")["securable_type"].alias("securable_type"),
                      F.col("request_params")["securable_full_name"].alias("securable"),
                      F.col("request_params")["changes"].alias("changes"))
    return rows if prefix is None else rows.filter(F.col("securable").like(prefix + "%"))


def sensitive_reads(lineage: DataFrame, tables: list[str], as_of: str, days: int) -> DataFrame:
    """Who read the listed tables, how often, first and last time."""
    return (audit_window(lineage, as_of, days).filter(F.col("source_table").isin(tables))
            .groupBy(F.col("created_by").alias("who"), F.col("source_table").alias("table_read"))
            .agg(F.count("*").alias("reads"), F.min("event_time").alias("first_read"),
                 F.max("event_time").alias("last_read")))


def denials(log: DataFrame, as_of: str, days: int) -> DataFrame:
    """Refused requests."""
    return (audit_window(log, as_of, days)
            .filter(F.col("response.error_message").ilike("%permission_denied%"))
            .select("event_time", F.col("user_identity.email").alias("actor"), "action_name",
                    F.col("request_params")["securable_full_name"].alias("securable"),
                    F.col("response.error_message").alias("error_message")))


def service_principals(grants: DataFrame) -> DataFrame:
    """Grants whose grantee has the shape of a UUID."""
    return grants.filter(F.col("grantee").rlike("^[0-9a-f]{8}-[0-9a-f]{4}-"))


def credential_events(log: DataFrame, as_of: str, days: int) -> DataFrame:
    return (audit_window(log, as_of, days).filter(F.col("action_name").ilike("%serviceprincipal%"))
            .select("event_time", F.col("user_identity.email").alias("actor"), "action_name"))


def code_activity(log: DataFrame, as_of: str, days: int) -> DataFrame:
    """Who did what to code, how often and when last."""
    return (audit_window(log, as_of, days).filter(F.col("service_name") == "notebook")
            .groupBy(F.col("user_identity.email").alias("actor"), "action_name")
            .agg(F.count("*").alias("n"), F.max("event_time").alias("last_event")))


def sql_text(value: str) -> str:
    """A string as a SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_secured_view(
    spark: SparkSession, name: str, source: str, schema: str, table: str, policies: Policies,
    principal: str, access: str, memberships: str,
) -> None:
    """One view per principal over named tables: readers of the view never name a policy.

    The view keeps its text, so the memberships and mappings of the moment of
    reading decide: a revoked admin loses access at once.
    """
    register_sql_masks(spark)
    who = sql_text(principal)
    role = (f"(SELECT CASE WHEN bool_or(m.group_name = '{ADMIN_GROUP}') THEN 'admin' WHEN bool_or(m.group_name = '{FACULTY_GROUP}') THEN 'faculty' "
            f"ELSE 'other' END FROM {memberships} m WHERE m.principal = {who})")
    masks = {c: m for (s, t, c), m in policies.masks.items() if (s, t) == (schema, table)}
    columns = ", ".join(f"mask_{masks[c]}(`{c}`, {role}) AS `{c}`" if c in masks else f"`{c}`" for c in spark.table(source).columns)
    col = policies.filters.get((schema, table))
    rows = "" if col is None else (
        f" WHERE {role} = 'admin' OR `{col}` IN (SELECT a.`{col}` FROM {access} a LEFT JOIN {memberships} g ON a.principal = g.group_name "
        f"WHERE a.principal = {who} OR g.principal = {who})")
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS SELECT {columns} FROM {source}{rows}")


def create_policy_view(
    spark: SparkSession, name: str, source: str, schema: str, table: str, policies: Policies,
    access: str, memberships: str, self_col: str | None = None,
) -> None:
    """One stored view for everyone: who reads it decides what it shows.

    ``source``, ``access`` and ``memberships`` are stored tables. Filter and
    masks ask ``current_user()`` and those tables whenever the view is read, so
    it names no principal, outlives the session that made it, and a changed
    membership or mapping counts at once. Admins see all rows, other principals
    those mapped to them or their groups; with ``self_col`` students also see
    the rows that name them. Masked columns are whole for admins, partial for
    faculty and NULL for others. NULL filter values are for admins alone.
    """
    own = "m.principal = current_user()"
    held = lambda group: f"EXISTS (SELECT 1 FROM {memberships} m WHERE {own} AND m.group_name = '{group}')"
    role = (f"(SELECT CASE WHEN bool_or(m.group_name = '{ADMIN_GROUP}') THEN 'admin' WHEN bool_or(m.group_name = '{FACULTY_GROUP}') THEN 'faculty' "
            f"WHEN bool_or(m.group_name = '{STUDENT_GROUP}') THEN 'student' ELSE 'other' END FROM {memberships} m WHERE {own})")
    by_column = {c: m for (s, t, c), m in policies.masks.items() if (s, t) == (schema, table)}
    shown = [f"CASE __viewer WHEN 'admin' THEN `{c}` WHEN 'faculty' THEN {partial_sql(by_column[c], f'`{c}`')} END AS `{c}`" if c in by_column else f"`{c}`"
             for c in spark.table(source).columns]
    col = policies.filters.get((schema, table))
    rows = ""
    if col is not None:
        mapped = (f"SELECT a.`{col}` FROM {access} a WHERE a.principal = current_user() "
                  f"OR a.principal IN (SELECT m.group_name FROM {memberships} m WHERE {own})")
        rows = f" WHERE {held(ADMIN_GROUP)} OR `{col}` IN ({mapped})"
        if self_col:
            rows += f" OR (`{self_col}` = current_user() AND {held(STUDENT_GROUP)})"
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {', '.join(shown)} FROM (SELECT *, {role} AS __viewer FROM {source}{rows})")


def tier_predicate(role: Column, own_dept: Column, dept: Column, own_id: Column, row_id: Column) -> Column:
    """Three tiers as one predicate over already resolved identities."""
    return (F.when(role == "admin", F.lit(True)).when(role == "faculty", dept == own_dept)
            .when(role == "student", row_id == own_id).otherwise(F.lit(False)))
