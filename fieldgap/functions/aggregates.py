"""Aggregate expressions with defined null and tie behaviour (A-1..A-12, A-17).

All of them are ordinary aggregates with map-side partial aggregation, so a hot group is
reduced before the shuffle and never collected into one task.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def max_by_present(x: Column, y: Column, tie: Column | None = None) -> Column:
    """x at the largest y among rows where both are present; smallest `tie` decides ties."""
    present = x.isNotNull() & y.isNotNull()
    order = y if tie is None else F.struct(y, -tie)
    return F.max_by(x, F.when(present, order))


def min_by_present(x: Column, y: Column, tie: Column | None = None) -> Column:
    """x at the smallest y among rows where both are present; smallest `tie` decides ties."""
    present = x.isNotNull() & y.isNotNull()
    order = y if tie is None else F.struct(y, tie)
    return F.min_by(x, F.when(present, order))


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def distinct_where(x: Column, condition: Column) -> Column:
    """count(distinct x) over the rows that satisfy the condition."""
    return F.count_distinct(F.when(condition, x))


def distinct_tuples(*cols: Column) -> Column:
    """Distinct combinations; a NULL in any part drops the row."""
    return F.count_distinct(*cols)


def distinct_list(c: Column) -> Column:
    """Sorted distinct values. Only for value sets with a small fixed domain."""
    return F.sort_array(F.collect_set(c))


def ratio(numerator: Column, denominator: Column, digits: int = 4) -> Column:
    """Rounded quotient, NULL when the denominator is 0 or missing."""
    return F.round(F.try_divide(numerator, denominator), digits)


def mean(c: Column, digits: int | None = None) -> Column:
    """Average as a double, also over decimals."""
    out = F.avg(c.cast("double"))
    return out if digits is None else F.round(out, digits)
