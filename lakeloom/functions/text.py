"""Text expressions (F01, F02, F15). All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def formal_name(last: str, first: str) -> Column:
    """``LAST, First``; missing parts are skipped."""
    return F.concat_ws(", ", F.upper(F.trim(F.col(last))), F.initcap(F.trim(F.col(first))))


def display_name(first: str, last: str) -> Column:
    return F.concat(F.col(first), F.lit(" "), F.col(last))


def after(col: str, sep: str) -> Column:
    """Text after the first separator, NULL if there is none (no ANSI error)."""
    return F.get(F.split(F.col(col), sep), F.lit(1))


def initials(first: str, last: str) -> Column:
    letters = F.regexp_replace(F.col(last), "[^A-Za-z]", "")
    return F.concat(F.substring(F.col(first), 1, 1), F.substring(letters, 1, 1))


def squeeze(col: Column | str, width: int | None = None) -> Column:
    """Collapse runs of white space; optionally keep the first ``width`` characters."""
    out = F.regexp_replace(F.col(col) if isinstance(col, str) else col, r"\s+", " ")
    return F.substring(out, 1, width) if width else out


def identifier(col: Column | str, prefix: str = "wksp_") -> Column:
    """A safe schema name: every character outside [A-Za-z0-9] becomes ``_``."""
    value = F.col(col) if isinstance(col, str) else col
    return F.concat(F.lit(prefix), F.regexp_replace(value, "[^a-zA-Z0-9]", "_"))


def matches_any(col: Column | str, fragments: list[str]) -> Column:
    """Case-blind "contains one of"."""
    value = F.lower(F.col(col) if isinstance(col, str) else col)
    out = F.lit(False)
    for fragment in fragments:
        out = out | value.contains(fragment.lower())
    return out
