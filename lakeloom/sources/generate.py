"""Seeded generators without driver loops.

Every draw is a hash of (row id, seed), so a row is the same however the range
is partitioned, retried or re-evaluated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions.fixed import GRADE_POINTS, GRADE_WEIGHTS
from lakeloom.functions.values import points


def draw(key: Column, seed: int, below: int) -> Column:
    """A whole number in [0, below), uniform over keys."""
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(below))


def weighted(key: Column, seed: int, values: list[str], weights: list[int]) -> Column:
    """A category drawn with integer weights."""
    ticket, upto, out = draw(key, seed, sum(weights)), 0, None
    for value, weight in zip(values, weights):
        upto += weight
        out = F.when(ticket < upto, value) if out is None else out.when(ticket < upto, value)
    return out


def generate_dim(spark: SparkSession, n: int, columns: dict[str, Column]) -> DataFrame:
    """n rows with ids from 1; each column is an expression over ``id`` such as ``weighted`` or ``draw``."""
    return spark.range(1, n + 1).select("id", *[value.alias(name) for name, value in columns.items()])


def generate_fact(
    spark: SparkSession, n: int, students: DataFrame, n_courses: int, n_terms: int, seed: int = 42,
) -> DataFrame:
    """n enrolment rows over existing students; the department comes from the student."""
    ids = students.select("student_id").agg(F.max("student_id")).first()[0] + 1  # one value
    rows = spark.range(n).select(
        F.col("id").alias("enrollment_id"), draw(F.col("id"), seed, ids).alias("student_id"),
        draw(F.col("id"), seed + 1, n_courses).alias("course_id"),
        (draw(F.col("id"), seed + 2, n_terms) + 1).alias("term_id"),
        weighted(F.col("id"), seed + 3, list(GRADE_POINTS), GRADE_WEIGHTS).alias("grade"))
    graded = rows.withColumn("gpa_points", points("grade"))
    return graded.join(students.select("student_id", "dept_id"), "student_id", "left")


def plant(df: DataFrame, key: str, rules: dict[str, tuple[int, Column]]) -> DataFrame:
    """Set a column to a planted value on every n-th key."""
    return df.withColumns({c: F.when(F.col(key) % n == 0, value).otherwise(F.col(c))
                           for c, (n, value) in rules.items()})


def dirty_dates(key: str, date: Column) -> Column:
    """The same date written in one of three formats by key."""
    kind = F.col(key) % 3
    return (F.when(kind == 0, F.date_format(date, "yyyy-MM-dd"))
            .when(kind == 1, F.date_format(date, "MM/dd/yyyy")).otherwise(F.date_format(date, "dd.MM.yyyy")))
