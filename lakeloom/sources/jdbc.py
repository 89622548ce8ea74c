"""Relational extracts through Spark's JDBC source.

Connection properties (driver, user, password) are given by the caller.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def jdbc_full(
    spark: SparkSession, url: str, table: str, part_col: str, lower: int, upper: int, parts: int, **props: str,
) -> DataFrame:
    """Whole table in ``parts`` parallel ranges of a numeric column."""
    return spark.read.jdbc(url, table, column=part_col, lowerBound=lower, upperBound=upper,
                           numPartitions=parts, properties=props)


def jdbc_query(spark: SparkSession, url: str, sql: str, **props: str) -> DataFrame:
    """Result of a query that runs in the database."""
    return spark.read.format("jdbc").option("url", url).option("query", sql).options(**props).load()


def jdbc_since(
    spark: SparkSession, url: str, table: str, col: str, mark, part_col: str, lower: int, upper: int, parts: int,
    **props: str,
) -> DataFrame:
    """Rows above a high-water mark; the filter is pushed to the database."""
    rows = jdbc_full(spark, url, table, part_col, lower, upper, parts, **props)
    return rows if mark is None else rows.filter(F.col(col) > F.lit(mark))
