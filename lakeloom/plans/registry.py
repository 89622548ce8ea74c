"""Queries by name, each with the SQL that checks it where SQL can."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lakeloom.plans.campus import Campus
from lakeloom.plans.oracle import oracle


@dataclass(frozen=True)
class Query:
    name: str
    rows: tuple[str, ...]
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(rows: str, sql: str | None = None, needs: str = "", recursive: bool = False):
    """Register a function of a Campus under its own name.

    ``rows`` names the inventory rows it covers, ``sql`` the checking statement.
    """
    def add(fn: Callable[[Campus], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Campus(spark, sf_dir))

        name = fn.__name__
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(name, tuple(rows.split()), run, oracle(needs, sql, recursive) if sql else None)
        return fn

    return add
