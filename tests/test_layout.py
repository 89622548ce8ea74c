"""Interleaved layout: a filter on either key alone meets few files."""

import pytest
from pyspark.sql import functions as F

from lakeloom.sinks.tables import write_interleaved


def files_met(df, key, value):
    """Files whose footer range of the key holds the value, of all files."""
    ranges = df.groupBy(F.input_file_name().alias("f")).agg(F.min(key).alias("low"), F.max(key).alias("high"))
    return ranges.filter((F.col("low") <= value) & (F.col("high") >= value)).count(), ranges.count()


def test_either_key_reads_a_quarter_of_the_files(spark, tmp_path):
    rows = spark.range(60_000).select("id", F.pmod(F.xxhash64("id"), F.lit(997)).cast("int").alias("a"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(5000)).alias("b"))
    laid = write_interleaved(rows, str(tmp_path / "z"), ["a", "b"])
    for key, values in (("a", (3, 500, 990)), ("b", (17, 2500, 4990))):
        for value in values:
            met, total = files_met(laid, key, value)
            assert total >= 48 and met <= total / 4, (key, value, met, total)
    assert laid.exceptAll(rows).isEmpty() and laid.count() == 60_000


def test_few_values_nulls_and_a_hot_pair(spark, tmp_path):
    rows = spark.range(9_000).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 24).alias("a"),
                                     F.when(F.col("id") < 4_000, F.lit("2024-01-01").cast("date")).otherwise(F.date_add(F.lit("2024-01-01"), (F.col("id") % 300).cast("int"))).alias("b"))
    laid = write_interleaved(rows, str(tmp_path / "z"), ["a", "b"], files=16)
    assert laid.exceptAll(rows).isEmpty() and laid.count() == 9_000 and laid.dtypes == rows.dtypes
    assert laid.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0] < 2_500


@pytest.mark.parametrize("keys", [["a"], ["a", "b", "id"]])
def test_any_number_of_keys_and_an_empty_table(spark, tmp_path, keys):
    rows = spark.range(500).select("id", (F.col("id") % 7).alias("a"), (F.col("id") % 11).alias("b"))
    assert write_interleaved(rows, str(tmp_path / "z"), keys, files=8).exceptAll(rows).isEmpty()
    assert write_interleaved(rows.limit(0), str(tmp_path / "e"), keys, files=8).isEmpty()
