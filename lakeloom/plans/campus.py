"""Campus-shaped views over the given tables; one lazy DataFrame per entity."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeloom.functions.fixed import GRADE_POINTS
from lakeloom.session import tune

GRADES = list(GRADE_POINTS)
_schemas: dict[tuple[str, str], StructType] = {}


def term_of(date: str) -> Column:
    """Term number of a date: three terms per year from 1995 on."""
    third = F.floor((F.month(date) - 1) / 4) + 1
    return ((F.year(date) - 1995) * 3 + third).cast("long")


def _pick(index: Column, values: list) -> Column:
    kind = "string" if isinstance(values[0], str) else "double"
    return F.get(F.array(*[F.lit(v).cast(kind) for v in values]), index.cast("int"))


def grade_at(index: Column) -> Column:
    return _pick(index, GRADES)


def points_at(index: Column) -> Column:
    return _pick(index, list(GRADE_POINTS.values()))


def digits(*parts: tuple[Column, int]) -> Column:
    return F.concat_ws("-", *[F.lpad(value.cast("string"), width, "0") for value, width in parts])


class Campus:
    """Entities over one data directory. Nothing is read until an action runs."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir.rstrip("/")
        tune(spark)

    def raw(self, name: str) -> DataFrame:
        """A given table; its schema is read from the files once per session, as a catalog would keep it."""
        path = f"{self.dir}/{name}.parquet"
        known = _schemas.get((self.spark.sparkContext.applicationId, path))
        if known is None:
            known = self.spark.read.parquet(path).schema
            _schemas[self.spark.sparkContext.applicationId, path] = known
        return self.spark.read.schema(known).parquet(path)

    def size(self, name: str) -> int:
        """Row count from the file footers."""
        return self.raw(name).count()

    @cached_property
    def department(self) -> DataFrame:
        nation, region = self.raw("nation"), self.raw("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            F.col("n_nationkey").cast("long").alias("dept_id"), F.col("n_name").alias("name"),
            F.col("r_name").alias("division"))

    @cached_property
    def term(self) -> DataFrame:
        third = F.floor((F.month("o_orderdate") - 1) / 4).cast("int")
        return (self.raw("orders").select(F.year("o_orderdate").alias("year"), third.alias("t")).distinct()
                .select(((F.col("year") - 1995) * 3 + F.col("t") + 1).cast("long").alias("term_id"), "year",
                        _pick(F.col("t"), ["Spring", "Summer", "Fall"]).alias("season"),
                        F.make_date("year", F.col("t") * 4 + 1, F.lit(1)).alias("start_date"),
                        F.last_day(F.make_date("year", F.col("t") * 4 + 4, F.lit(1))).alias("end_date")))

    @cached_property
    def student(self) -> DataFrame:
        key, segment = F.col("c_custkey"), F.col("c_mktsegment")
        born = F.date_add(F.lit("1995-01-01").cast("date"), (key * 7 % 4745).cast("int"))
        dob = (F.when(key % 3 == 0, F.date_format(born, "yyyy-MM-dd"))
               .when(key % 3 == 1, F.date_format(born, "MM/dd/yyyy")).otherwise(F.date_format(born, "dd.MM.yyyy")))
        status = (F.when(key % 20 == 0, "leave").when(segment == "HOUSEHOLD", "graduated")
                  .when(segment == "FURNITURE", "withdrawn").otherwise("active"))
        return self.raw("customer").select(
            key.alias("student_id"),
            F.when(key % 5 == 0, F.upper(segment)).otherwise(F.lower(segment)).alias("first_name"),
            F.col("c_name").alias("last_name"),
            digits((900 + key % 100, 3), (F.floor(key / 100) % 100, 2), (F.floor(key / 10000) % 10000, 4)).alias("ssn"),
            dob.alias("dob"), F.col("c_nationkey").cast("long").alias("dept_id"), status.alias("status"),
            F.when(key % 50 != 0, F.concat(F.lit("student"), key.cast("string"), F.lit("@campus.example"))).alias("email"))

    @cached_property
    def faculty(self) -> DataFrame:
        key = F.col("s_suppkey")
        rank = (F.when(F.col("s_acctbal") >= 6000, "Professor").when(F.col("s_acctbal") >= 3000, "Associate")
                .otherwise("Assistant"))
        return self.raw("supplier").select(
            key.alias("faculty_id"), F.col("s_name").alias("name"),
            digits((950 + key % 50, 3), (F.floor(key / 50) % 100, 2), (F.floor(key / 5000) % 10000, 4)).alias("ssn"),
            F.col("s_nationkey").cast("long").alias("dept_id"), rank.alias("rank"))

    @cached_property
    def course(self) -> DataFrame:
        key, teachers = F.col("p_partkey"), self.size("supplier")
        return self.raw("part").select(
            key.alias("course_id"), (key % 25).alias("dept_id"), (key % teachers).alias("faculty_id"),
            F.col("p_name").alias("title"), (F.col("p_size") % 4 + 1).alias("credits"))

    @cached_property
    def enrollment(self) -> DataFrame:
        key, courses = F.col("o_orderkey"), self.size("part")
        return self.raw("orders").select(
            key.alias("enrollment_id"), F.col("o_custkey").alias("student_id"), (key % courses).alias("course_id"),
            term_of("o_orderdate").alias("term_id"), grade_at(key % 10).alias("grade"),
            points_at(key % 10).alias("gpa_points"))

    @cached_property
    def history(self) -> DataFrame:
        """The large fact: lineitem with its order and customer."""
        index = F.floor((F.col("l_quantity") - 1) / 5)
        orders = self.raw("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        customer = self.raw("customer").select("c_custkey", "c_nationkey")
        joined = (self.raw("lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
                  .join(customer, F.col("o_custkey") == F.col("c_custkey")))
        return joined.select(
            F.col("l_orderkey").alias("enrollment_id"), F.col("o_custkey").alias("student_id"),
            F.col("l_partkey").alias("course_id"), term_of("o_orderdate").alias("term_id"),
            F.col("c_nationkey").cast("long").alias("dept_id"), grade_at(index).alias("grade"),
            points_at(index).alias("gpa_points"), F.col("l_shipdate").alias("load_ts"))

    @cached_property
    def aid(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("aid_id"), F.col("o_custkey").alias("student_id"),
            F.col("o_totalprice").alias("amount"), F.col("o_orderpriority").alias("aid_type"),
            term_of("o_orderdate").alias("term_id"))

    @cached_property
    def budget(self) -> DataFrame:
        return self.department.select(
            "dept_id", F.col("name").alias("dept_name"), (500000 + F.col("dept_id") * 25000).alias("budget_amount"),
            F.lit("2024-07-01").cast("date").alias("approved_date"))

    # -- logs over events ------------------------------------------------

    @cached_property
    def _events(self) -> DataFrame:
        return self.raw("events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))

    @cached_property
    def query_history(self) -> DataFrame:
        ms = F.round(F.col("value") * 20).cast("long")
        kind = F.col("event_type")
        end = F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (ms / 1000).cast("decimal(18,6)"))
        return self._events.select(
            F.col("event_id").alias("statement_id"), F.concat(F.lit("user"), F.col("user_id")).alias("executed_by"),
            F.struct(F.concat(F.lit("wh_"), F.col("k") % 5).alias("warehouse_id")).alias("compute"),
            F.col("ts").alias("start_time"), end.alias("end_time"), ms.alias("total_duration_ms"),
            F.round(F.greatest(F.col("value") - 200, F.lit(0.0)) * 100).cast("long").alias("waiting_ms"),
            (F.col("k") * 10).cast("long").alias("read_rows"),
            F.when(kind == "error", "FAILED").when(kind == "signup", "CANCELED").otherwise("FINISHED").alias("execution_status"),
            F.concat(F.lit("SELECT  *   FROM "), kind, F.lit("_log  WHERE k = "), F.col("k")).alias("statement_text"),
            F.when(F.col("k") < 50, F.concat(F.lit("nb_"), F.col("k") % 10)).alias("notebook_id"))

    @cached_property
    def job_periods(self) -> DataFrame:
        state = (F.when(F.col("event_type").isin("click", "purchase"), "SUCCEEDED")
                 .when(F.col("event_type") == "error", "FAILED").when(F.col("event_type") == "signup", "CANCELED"))
        took = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("value").cast("decimal(18,6)"))
        return self._events.select(
            F.col("user_id").alias("job_id"),
            F.concat(F.col("user_id"), F.lit("_"), F.col("ts").cast("date").cast("string")).alias("run_id"),
            F.col("event_type").alias("task_key"), F.col("ts").alias("period_start"),
            (F.col("ts") + took).alias("period_end"), state.alias("result_state"))

    @cached_property
    def jobs(self) -> DataFrame:
        return self._events.filter(F.col("event_type") == "signup").select(
            F.col("user_id").alias("job_id"),
            F.concat(F.lit("job_"), F.col("user_id"), F.lit("_"), F.col("k") % 7).alias("name"),
            F.col("ts").alias("change_time"),
            F.when(F.col("k") >= 95, F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("delete_time"))

    @cached_property
    def pipeline_periods(self) -> DataFrame:
        took = F.make_dt_interval(F.lit(0), F.lit(0), F.col("l_quantity").cast("int"))
        return self.raw("lineitem").select(
            F.col("l_suppkey").alias("pipeline_id"), F.col("l_orderkey").alias("update_id"),
            F.col("l_shipdate").alias("period_start"), (F.col("l_shipdate") + took).alias("period_end"),
            F.when(F.col("l_returnflag") == "R", "FAILED").when(F.col("l_returnflag") == "A", "COMPLETED")
            .alias("result_state"))

    @cached_property
    def pipelines(self) -> DataFrame:
        return self.raw("supplier").select(
            F.col("s_suppkey").alias("pipeline_id"), F.col("s_name").alias("name"),
            F.lit("1995-01-01").cast("timestamp_ntz").alias("change_time"),
            F.when(F.col("s_acctbal") < 500, F.lit("2000-01-01").cast("timestamp_ntz")).alias("delete_time"))

    @cached_property
    def warehouse_events(self) -> DataFrame:
        kind = F.col("event_type")
        return self._events.select(
            F.concat(F.lit("wh_"), F.col("k") % 5).alias("warehouse_id"),
            F.when(kind == "signup", "SCALED_UP").when(kind == "purchase", "SCALED_DOWN").otherwise("RUNNING").alias("event_type"),
            (1 + F.col("k") % 8).alias("cluster_count"), F.col("ts").alias("event_time"))

    @cached_property
    def audit(self) -> DataFrame:
        kind, k, user = F.col("event_type"), F.col("k"), F.col("user_id")
        email = F.when(user % 10 == 0, F.format_string("%08x-0000-4000-8000-%012x", user, user)).otherwise(
            F.concat(F.lit("user"), user, F.lit("@campus.example")))
        schema = F.when(F.floor(k / 4) % 2 == 0, "silver").otherwise("sandbox")
        table = _pick(k % 4, ["student", "faculty", "financial_aid", "enrollment"])
        action = (F.when(kind == "click", "openNotebook").when(kind == "purchase", "modifyNotebook")
                  .when(kind == "signup", "updatePermissions")
                  .when((kind == "view") & (k < 10), "rotateServicePrincipalSecret").otherwise("getTable"))
        service = (F.when(kind.isin("click", "purchase"), "notebook").when(kind == "view", "accounts")
                   .otherwise("catalog"))
        changes = F.concat(F.lit('[{"principal":"user'), k, F.lit('","add":["SELECT"]}]'))
        error = F.when((kind == "error") & (k < 60), "Permission_Denied: no SELECT").when(kind == "error", "TIMEOUT")
        return self._events.select(
            F.col("ts").alias("event_time"), F.col("ts").cast("date").alias("event_date"),
            F.struct(email.alias("email")).alias("user_identity"), service.alias("service_name"),
            action.alias("action_name"),
            F.create_map(F.lit("securable_type"), F.lit("TABLE"), F.lit("securable_full_name"),
                         F.concat(F.lit("lake."), schema, F.lit("."), table),
                         F.lit("changes"), changes).alias("request_params"),
            F.struct(error.alias("error_message")).alias("response"), k.alias("k"))

    @cached_property
    def reads(self) -> DataFrame:
        return self.audit.filter(F.col("action_name").isin("getTable", "openNotebook")).select(
            F.col("request_params")["securable_full_name"].alias("source_table"),
            F.col("user_identity.email").alias("created_by"), "event_time", "event_date")

    @cached_property
    def grants(self) -> DataFrame:
        k = F.col("k")
        scope = _pick(k % 4, ["catalog", "schema", "table", "function"])
        schema = F.concat(F.lit("lake."), F.when(F.floor(k / 4) % 2 == 0, "silver").otherwise("sandbox"))
        obj = (F.when(k % 4 == 0, "lake").when(k % 4 == 1, schema)
               .when(k % 4 == 2, F.concat(schema, F.lit(".financial_aid")))
               .otherwise("lake.sandbox.mask_partial"))
        right = F.when(k % 4 == 3, F.when(F.floor(k / 8) % 2 == 0, "EXECUTE").otherwise("OWN")).otherwise(
            _pick(F.floor(k / 8) % 3, ["SELECT", "MODIFY", "USE"]))
        return self.audit.filter(F.col("action_name") == "updatePermissions").select(
            F.col("user_identity.email").alias("grantee"), scope.alias("scope"), obj.alias("object_name"),
            right.alias("privilege_type")).distinct()

    # -- usage, access, lineage ------------------------------------------

    @cached_property
    def usage(self) -> DataFrame:
        part = self.raw("part").select("p_partkey", "p_brand", "p_type")
        return self.raw("lineitem").join(part, F.col("l_partkey") == F.col("p_partkey")).select(
            F.col("p_brand").alias("sku_name"), F.col("p_type").alias("product"), F.col("l_quantity").alias("quantity"),
            F.col("l_shipdate").alias("usage_end"), F.col("l_shipdate").cast("date").alias("usage_date"),
            F.col("l_orderkey").alias("order_id"))

    @cached_property
    def usage_tagged(self) -> DataFrame:
        orders = self.raw("orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
        customer = self.raw("customer").select("c_custkey", "c_mktsegment")
        tags = F.when(F.col("o_orderstatus") == "P", F.create_map().cast("map<string,string>")).otherwise(
            F.create_map(F.lit("segment"), F.col("c_mktsegment"), F.lit("priority"), F.col("o_orderpriority")))
        return (self.usage.join(orders, F.col("order_id") == F.col("o_orderkey"))
                .join(customer, F.col("o_custkey") == F.col("c_custkey"))
                .select(*self.usage.columns, tags.alias("tags")))

    @cached_property
    def prices(self) -> DataFrame:
        brands = self.raw("part").select(F.col("p_brand").alias("sku_name")).distinct()
        years = brands.filter(F.col("sku_name") != "Brand#25").withColumn("y", F.explode(F.sequence(F.lit(1995), F.lit(2001))))
        number = F.substring("sku_name", 7, 9).cast("int")
        start = F.make_date("y", F.lit(1), F.lit(1)).cast("timestamp_ntz")
        end = F.when(F.col("y") < 2001, F.make_date(F.col("y") + 1, F.lit(1), F.lit(1)).cast("timestamp_ntz"))
        return years.select("sku_name", start.alias("price_start"), end.alias("price_end"),
                            F.round((100 + number * 10 + (F.col("y") - 1995) * 5) / 100, 2).alias("price"))

    @cached_property
    def access(self) -> DataFrame:
        users = self.faculty.select(F.col("name").alias("principal"), "dept_id")
        groups = self.department.select(F.concat(F.lit("division:"), F.col("division")).alias("principal"), "dept_id")
        return users.unionByName(groups).withColumn("granted_by", F.lit("setup")).withColumn(
            "granted_at", F.lit("2024-01-01").cast("timestamp_ntz"))

    @cached_property
    def memberships(self) -> DataFrame:
        supplier = self.raw("supplier").select(F.col("s_nationkey").cast("long").alias("dept_id"), "s_name", "s_acctbal")
        divisions = supplier.filter(F.col("s_acctbal") > 5000).join(self.department, "dept_id").select(
            F.col("s_name").alias("principal"), F.concat(F.lit("division:"), F.col("division")).alias("group_name"))
        admins = supplier.filter(F.col("s_acctbal") >= 9000).select(
            F.col("s_name").alias("principal"), F.lit("admins").alias("group_name"))
        return divisions.unionByName(admins)

    @cached_property
    def student_memberships(self) -> DataFrame:
        return self.memberships.unionByName(self.student.filter(F.col("email").isNotNull()).select(
            F.col("email").alias("principal"), F.lit("students").alias("group_name")))

    @cached_property
    def lineage(self) -> DataFrame:
        def node(prefix: str, col: str) -> Column:
            return F.concat(F.lit(prefix), F.col(col).cast("string"))

        part = self.raw("part")
        feeds = self.raw("lineitem").select(node("raw.s", "l_suppkey").alias("source_table"),
                                            node("silver.p", "l_partkey").alias("target_table"))
        marts = part.select(node("silver.p", "p_partkey").alias("source_table"), node("gold.", "p_brand").alias("target_table"))
        reports = part.select(node("gold.", "p_brand").alias("source_table"), node("report.", "p_type").alias("target_table"))
        return feeds.unionByName(marts).unionByName(reports)

    # -- snapshots ---------------------------------------------------------

    def snapshot(self, version: int) -> DataFrame:
        """State of all users active in one third of the event log, one row per user."""
        first = {1: "2024-01-01", 2: "2024-01-11", 3: "2024-01-21"}[version]
        last = {1: "2024-01-11", 2: "2024-01-21", 3: "2024-02-01"}[version]
        day = F.col("ts")
        span = self.raw("events").filter((day >= F.lit(first).cast("timestamp_ntz")) & (day < F.lit(last).cast("timestamp_ntz")))
        return span.groupBy("user_id", "event_type").agg(F.max("value").alias("peak")).select(
            F.concat_ws("-", F.col("user_id").cast("string"), "event_type").alias("account_id"),
            (F.floor(F.col("peak") / 100)).cast("int").alias("level"),
            F.when(F.col("peak") >= 50, "active").otherwise("dormant").alias("status"))
