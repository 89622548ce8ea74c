"""Date and time expressions (F03-F07). ``as_of`` is always passed in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeloom.functions.fixed import DATE_FORMATS


def parse_mixed_date(col: str, formats: list[str] = DATE_FORMATS) -> Column:
    """First format that parses wins; NULL when none does."""
    return F.coalesce(*[F.try_to_date(F.col(col), fmt) for fmt in formats])


def age_years(born: Column, as_of: str) -> Column:
    return F.floor(F.datediff(F.lit(as_of).cast("date"), born) / F.lit(365.25)).cast("int")


def age_by_year(born: Column, as_of: str) -> Column:
    return F.year(F.lit(as_of).cast("date")) - F.year(born)


def weekday(col: Column) -> Column:
    return F.date_format(col, "EEEE")


def in_zone(ts: Column, zone: str) -> Column:
    """Wall-clock time in ``zone`` of a UTC wall-clock time, daylight saving included.

    Works on times without zone, so the session's own zone plays no part.
    """
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts)


def seconds_between(start: Column, end: Column) -> Column:
    return F.unix_timestamp(end.cast("timestamp")) - F.unix_timestamp(start.cast("timestamp"))


def minutes_between(start: Column, end: Column, digits: int = 2) -> Column:
    return F.round(seconds_between(start, end) / F.lit(60.0), digits)
