"""JSON files to a table whose columns grow with the files; what does not fit is kept."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DoubleType, LongType, MapType, StringType, StructField, StructType, VariantType

from lakeloom.streaming.files import _is_there

RESERVED = ("source_file", "rescued", "batch")
#: Key under which a line that is no JSON object is rescued.
WHOLE_LINE = "_line"


def kept_schema(spark: SparkSession, checkpoint: str) -> StructType:
    """The newest version of the schema kept beside the checkpoint; no column before the first run."""
    path = f"{checkpoint}_versions"
    if not _is_there(spark, path):
        return StructType()
    newest = spark.read.text(path).agg(F.max_by("value", F.col("version").cast("long"))).first()[0]
    return StructType.fromJson(json.loads(newest))


def _keep(spark: SparkSession, checkpoint: str, version: int, schema: StructType) -> None:
    row = spark.createDataFrame([(schema.json(),)], "value string")
    row.coalesce(1).write.mode("overwrite").text(f"{checkpoint}_versions/version={version}")


def _grown(lines: DataFrame, known: StructType) -> StructType:
    """``known`` with the columns that the lines add; types are looked at only where a line names an unknown key."""
    taken = {f.name.lower() for f in known.fields} | set(RESERVED) | {WHOLE_LINE}
    keys = lines.select(F.explode(F.map_keys("raw")).alias("key")).distinct()
    named = {r.key.lower(): r.key for r in keys.filter(~F.lower("key").isin(sorted(taken))).orderBy(F.desc("key")).collect()}
    if not named:
        return known
    new = sorted(named.values())
    wanted = F.from_json("value", StructType([StructField(key, VariantType()) for key in new]))
    kinds = lines.select(wanted.alias("w")).agg(*[F.schema_of_variant_agg(F.col("w").getField(key)) for key in new]).first()
    return StructType([*known.fields, *[StructField(key, _column_type(kind)) for key, kind in zip(new, kinds) if kind != "VOID"]])


def _column_type(kind: str) -> DataType:
    """Whole numbers, other numbers as doubles, truth values; everything else, mixed and nested values too, as text."""
    return {"BIGINT": LongType(), "BOOLEAN": BooleanType(), "DOUBLE": DoubleType()}.get(kind, DoubleType() if kind.startswith("DECIMAL") else StringType())


def _fitted(lines: DataFrame, schema: StructType) -> DataFrame:
    typed = F.from_json("value", schema) if schema.fields else F.lit(None)
    rows = lines.withColumn("typed", typed)
    own = [F.col("typed").getField(f.name) for f in schema.fields]
    fits = F.array_compact(F.array(F.lit(None).cast("string"), *[F.when(c.isNotNull(), F.lit(f.name)) for c, f in zip(own, schema.fields)]))
    left = F.map_filter("raw", lambda k, v: v.isNotNull() & ~F.array_contains("fits", k))
    kept = F.when(F.col("raw").isNull(), F.create_map(F.lit(WHOLE_LINE), F.col("value"))).otherwise(left)
    return rows.withColumn("fits", fits).select(*[c.alias(f.name) for c, f in zip(own, schema.fields)], "source_file",
                                                F.when(F.size(kept) > 0, kept).alias("rescued"))


def stream_evolving(spark: SparkSession, path: str, checkpoint: str, target: str, schema: StructType | str | None = None) -> DataFrame:
    """Append all JSON-lines files below ``path`` not yet seen to ``target`` and stop.

    A key that no version of the schema knows becomes a column from that batch
    on: the next version is kept under the number of the batch, older rows read
    NULL. Nothing is lost: a value that does not fit its column's type, a key
    that differs from a column by case or has a reserved name stays as text in
    the map ``rescued``; so does a line that is no object, under ``_line``.
    Blank lines are no rows. Nested values are kept as their JSON text, so that
    they cannot fail to fit. ``schema`` fixes the first version.

    A batch is one folder of the target, written over when it is run again, so
    a run cut short repeats and loses no row. Only new column names reach the
    driver.
    """
    if schema is not None and not _is_there(spark, f"{checkpoint}_versions"):
        _keep(spark, checkpoint, -1, StructType.fromDDL(schema) if isinstance(schema, str) else schema)

    def load(batch: DataFrame, number: int) -> None:
        own = batch.sparkSession
        lines = batch.filter(F.trim("value") != "").withColumn("raw", F.from_json("value", "map<string,string>"))
        known = kept_schema(own, checkpoint)
        grown = _grown(lines, known)
        if grown != known:
            _keep(own, checkpoint, number, grown)
        _fitted(lines, grown).write.mode("overwrite").parquet(f"{target}/batch={number}")

    source = (spark.readStream.format("text").option("recursiveFileLookup", "true").load(path)
              .select("value", F.col("_metadata.file_name").alias("source_file")))
    source.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return read_evolving(spark, checkpoint, target)


def read_evolving(spark: SparkSession, checkpoint: str, target: str) -> DataFrame:
    """All rows under the newest schema, with ``source_file`` and ``rescued``."""
    columns = [*kept_schema(spark, checkpoint).fields, StructField("source_file", StringType()), StructField("rescued", MapType(StringType(), StringType()))]
    whole = StructType(columns)
    if not _is_there(spark, target):
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).parquet(target).select(whole.names)
