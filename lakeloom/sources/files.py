"""Delimited, JSON, XML and upload readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CORRUPT = "_corrupt_record"


def read_delimited(
    spark: SparkSession, path: str, sep: str = ",", multiline: bool = False, schema: StructType | str | None = None,
) -> DataFrame:
    """Quoted text with header; a quoted field may hold the separator.

    ``multiline`` lets quoted fields hold line breaks but makes each file one
    task, so it is off unless the data needs it.
    """
    reader = (spark.read.option("header", True).option("sep", sep).option("quote", '"')
              .option("escape", '"').option("multiLine", multiline))
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def read_upload(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """An untrusted upload: fixed types and kept bad lines with a schema (S03), else inferred."""
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    kept = StructType([*schema.fields]).add(CORRUPT, "string")
    return reader.schema(kept).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(path)


def read_json(spark: SparkSession, path: str, multiline: bool = False, schema: StructType | str | None = None) -> DataFrame:
    """JSON lines by default; ``multiline`` is for files holding one document each."""
    reader = spark.read.option("multiLine", multiline)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: StructType | str | None = None) -> DataFrame:
    """Repeating elements as rows; an absent node is NULL, the row stays."""
    reader = spark.read.format("xml").option("rowTag", row_tag)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def read_dated(spark: SparkSession, path: str, glob: str, schema: StructType | str, date: str = r"(\d{8})") -> DataFrame:
    """Files picked by name pattern, with the date in the name as a column."""
    raw = (spark.read.option("header", True).option("pathGlobFilter", glob).schema(schema).csv(path)
           .select("*", F.col("_metadata.file_name").alias("file_name")))
    return raw.withColumn("file_date", F.to_date(F.regexp_extract("file_name", date, 1), "yyyyMMdd"))


def page(df: DataFrame, key: str | list[str], number: int, size: int) -> DataFrame:
    """Page ``number`` (from 1) in key order with a has_next flag.

    Reads size + 1 rows past the offset. For bulk paging use ``keyset_page``.
    """
    keys = [key] if isinstance(key, str) else key
    start = (number - 1) * size
    rows = df.orderBy(*keys).offset(start).limit(size)
    more = F.lit(not df.select(*keys).orderBy(*keys).offset(start + size).limit(1).isEmpty())
    return rows.withColumn("has_next", more)


def keyset_page(df: DataFrame, key: str, after, size: int) -> DataFrame:
    """The next ``size`` rows after a key value: the bound is pushed into the scan."""
    bounded = df if after is None else df.filter(F.col(key) > F.lit(after))
    return bounded.orderBy(key).limit(size)


def changed_since(df: DataFrame, col: str, mark) -> tuple[DataFrame, Column]:
    """Rows above a high-water mark, and the aggregate giving the next mark.

    The comparison is pushed into file and JDBC scans alike. Hard deletes are
    not seen this way; compare snapshots for those.
    """
    rows = df if mark is None else df.filter(F.col(col) > F.lit(mark))
    return rows, F.max(col)
