"""Classification, casts, null handling and exact averages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeloom.functions import fixed


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def lookup(value: Column | str, table: dict, default=None) -> Column:
    """A literal CASE over a small fixed table."""
    value = _col(value)
    out = None
    for key, result in table.items():
        if result is not None:
            out = F.when(value == key, F.lit(result)) if out is None else out.when(value == key, F.lit(result))
    return out.otherwise(F.lit(default)) if default is not None else out


def points(grade: Column | str) -> Column:
    """Grade to points; total over all ten grades, W gives NULL."""
    return lookup(grade, fixed.GRADE_POINTS)


def standing(status: Column | str) -> Column:
    return lookup(status, fixed.STANDING, fixed.OTHER_STANDING)


def run_status(state: Column | str) -> Column:
    out = None
    for label, states in fixed.RUN_STATUS.items():
        hit = _col(state).isin(states)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise("Other")


def below(value: Column | str, steps: list[tuple[float, str]], last: str) -> Column:
    """Label of the first step whose upper bound lies above the value."""
    value = _col(value)
    out = None
    for bound, label in steps:
        out = F.when(value < bound, label) if out is None else out.when(value < bound, label)
    return out.otherwise(last)


def bands(value: Column | str) -> tuple[Column, Column]:
    """(band label, band order) covering every value, NULL included."""
    value = _col(value)
    label = F.when(value.isNull(), fixed.NULL_BAND)
    order = F.when(value.isNull(), len(fixed.POINT_BANDS) + 2)
    for i, (bound, name) in enumerate(fixed.POINT_BANDS, start=1):
        label, order = label.when(value >= bound, name), order.when(value >= bound, i)
    return label.otherwise(fixed.LOWEST_BAND), order.otherwise(len(fixed.POINT_BANDS) + 1)


def throttled(waited: Column | str) -> Column:
    return F.when(_col(waited) > 0, 1).otherwise(0)


def allowed_or(value: Column | str, allowed: list[str], other: str = "unknown") -> Column:
    return F.when(_col(value).isin(allowed), _col(value)).otherwise(F.lit(other))


def all_of(predicates: list[Column | None]) -> Column:
    """AND of the given predicates; a missing one does not restrict."""
    return reduce(lambda a, b: a & b, [p for p in predicates if p is not None], F.lit(True))


def exact_sum(value: Column | str, scale: int) -> Column:
    """Sum of values with ``scale`` decimals, counted in smallest units.

    Adding whole numbers gives the same bits whatever order partitions arrive
    in, so results do not change between runs, retries or cluster sizes. High
    and low parts are added apart, so no total over a huge table overflows.
    """
    units, split = F.round(_col(value) * 10**scale).cast("long"), 20
    high, low = F.shiftright(units, split), units.bitwiseAND(F.lit(2**split - 1))
    return F.sum(high).cast("double") * float(2**split) + F.sum(low).cast("double")


def exact_total(value: Column | str, scale: int = 2) -> Column:
    return exact_sum(value, scale) / F.lit(float(10**scale))


def exact_avg(value: Column | str, scale: int, digits: int) -> Column:
    value = _col(value)
    return F.round(exact_sum(value, scale) / F.count(value) / F.lit(float(10**scale)), digits)
