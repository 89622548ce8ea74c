"""Table lineage and documentation."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions.text import matches_any
from lakeloom.session import durable


def edges(log: DataFrame) -> DataFrame:
    """Distinct source -> target pairs of a lineage log."""
    return log.select("source_table", "target_table").distinct()


def reachable(links: DataFrame, node: str, direction: str = "downstream") -> DataFrame:
    """Every table reachable from ``node`` with its smallest distance.

    Breadth first: each round joins only the newly found tables with the edges
    and drops those seen before, so cycles end and no path is enumerated. Each
    round is written to the shared folder; a lost executor repeats one round.
    """
    spark = links.sparkSession
    src, dst = ("source_table", "target_table") if direction == "downstream" else ("target_table", "source_table")
    hops = durable(links.select(F.col(src).alias("node"), F.col(dst).alias("next")).distinct(), "edges")
    start = spark.range(1).select(F.lit(node).alias("node"), F.lit(0).alias("depth"))
    found, frontier = start, start
    for depth in count(1):
        step = hops.join(frontier.select("node"), "node", "left_semi").select(F.col("next").alias("node")).distinct()
        step = step.join(found.select("node"), "node", "left_anti")
        frontier = durable(step.withColumn("depth", F.lit(depth)), "frontier")
        if frontier.isEmpty():
            break
        found = found.unionByName(frontier)
    return found.filter(F.col("depth") > 0).withColumnRenamed("node", "table_name")


def document(spark: SparkSession, table: str, comment: str, columns: dict[str, str]) -> None:
    """Store table and column comments in the catalog."""
    quoted = comment.replace("'", "\\'")
    spark.sql(f"COMMENT ON TABLE {table} IS '{quoted}'")
    for name, text in columns.items():
        spark.sql("ALTER TABLE {} ALTER COLUMN {} COMMENT '{}'".format(table, name, text.replace("'", "\\'")))


def documented_columns(spark: SparkSession, tables: list[str]) -> DataFrame:
    rows = [(t, c.name, c.dataType, c.description) for t in tables for c in spark.catalog.listColumns(t)]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string, comment string")


def search(catalog: DataFrame, word: str) -> DataFrame:
    """Columns whose name or comment mentions the word."""
    return catalog.filter(matches_any("column_name", [word])
                          | F.coalesce(matches_any("comment", [word]), F.lit(False)))
