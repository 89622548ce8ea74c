"""Column masks by role (G01-G03, D01). ``role`` is a literal or a column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeloom.functions.dates import parse_mixed_date


def _by_role(role: Column | str, full: Column, partial: Column) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    return F.when(role == "admin", full).when(role == "faculty", partial)


def mask_partial(col: str, role: Column | str) -> Column:
    """Full for admin, last four characters for faculty, NULL otherwise."""
    return _by_role(role, F.col(col), F.concat(F.lit("***-**-"), F.right(F.col(col), F.lit(4))))


def mask_year(col: str, role: Column | str) -> Column:
    """Full for admin, year only for faculty (NULL when unparseable), NULL otherwise."""
    year = F.year(parse_mixed_date(col)).cast("string")
    return _by_role(role, F.col(col), F.concat(year, F.lit("-XX-XX")))


def mask_round(col: str, role: Column | str, digits: int = -3) -> Column:
    """Exact for admin, rounded (default nearest thousand) for faculty, NULL otherwise."""
    return _by_role(role, F.col(col), F.round(F.col(col), digits))


MASKS = {"partial": mask_partial, "year": mask_year, "round": mask_round}


def partial_sql(mask: str, value: str) -> str:
    """What faculty sees of ``value``, as SQL text of built-in functions, for views that are stored."""
    from lakeloom.functions.fixed import DATE_FORMATS

    parsed = ", ".join(f"try_to_date({value}, '{fmt}')" for fmt in DATE_FORMATS)
    return {"partial": f"concat('***-**-', right({value}, 4))",
            "year": f"concat(cast(year(coalesce({parsed})) AS STRING), '-XX-XX')",
            "round": f"round({value}, -3)"}[mask]


def register_sql_masks(spark) -> None:
    """The same masks as SQL scalar functions for the session."""
    types = {"partial": "STRING", "year": "STRING", "round": "DOUBLE"}
    for mask, kind in types.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION mask_{mask}(v {kind}, role STRING) RETURNS {kind} "
            f"RETURN CASE role WHEN 'admin' THEN v WHEN 'faculty' THEN {partial_sql(mask, 'v')} END"
        )
