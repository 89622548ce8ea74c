"""Lakehouse data jobs on open-source Spark: DataFrames in, DataFrames out."""
