from __future__ import annotations

import operator
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from barloom.functions.exact import exact_sum


def any_of(conditions: Iterable[Column]) -> Column:
    """Disjunction of the conditions; FALSE when there are none."""
    return reduce(operator.or_, conditions, F.lit(False))


def holds(condition: Column) -> Column:
    """The condition, with an unknown (NULL) outcome counted as not met."""
    return F.coalesce(condition, F.lit(False))


def within(left: Column, right: Column, tolerance: float) -> Column:
    return F.abs(left - right) <= F.lit(tolerance)


def finite_double(name: str) -> Column:
    """Text to DOUBLE without raising; NaN and the infinities become NULL like any other unusable price."""
    value = F.col(name).try_cast("double")
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def last_weekday(day: Column) -> Column:
    """The latest Monday-to-Friday date on or before ``day``."""
    days_past_friday = F.greatest(F.weekday(day) - F.lit(4), F.lit(0))
    return F.date_sub(day, days_past_friday)


def year_end(year: Column) -> Column:
    return F.make_date(year, F.lit(12), F.lit(31))


def compounded(simple_return: Column) -> Column:
    """Aggregate: the product of (1 + r), the same whatever the order of the rows."""
    return F.exp(exact_sum(F.log1p(simple_return)))
