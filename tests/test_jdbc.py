"""The JDBC readers set the options Spark needs to read in parallel and push filters.

No database runs here, so this checks the calls and not their results.
"""

from unittest.mock import MagicMock

from lakeloom.sources import jdbc


def test_full_extract_is_split_by_range():
    spark = MagicMock()
    jdbc.jdbc_full(spark, "jdbc:x:y", "student", "student_id", 0, 1000, 16, driver="d")
    spark.read.jdbc.assert_called_once_with("jdbc:x:y", "student", column="student_id", lowerBound=0, upperBound=1000,
                                            numPartitions=16, properties={"driver": "d"})


def test_query_runs_in_the_database():
    spark = MagicMock()
    jdbc.jdbc_query(spark, "jdbc:x:y", "SELECT 1", driver="d")
    option = spark.read.format.return_value.option
    option.assert_called_once_with("url", "jdbc:x:y")
    option.return_value.option.assert_called_once_with("query", "SELECT 1")


def test_first_incremental_extract_is_unfiltered():
    spark = MagicMock()
    rows = jdbc.jdbc_since(spark, "jdbc:x:y", "student", "changed", None, "student_id", 0, 10, 2)
    assert rows is spark.read.jdbc.return_value
