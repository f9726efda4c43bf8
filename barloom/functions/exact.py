"""Sums of doubles that do not depend on the order of the rows.

Adding doubles rounds after every step, so partial sums of other partitions end in other bits. Here each value is cut into
a whole number and a rest, which is taken to a fixed number of decimals; both add up exactly, however they are grouped.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Decimals of the rest that are kept.
SCALE = 24


def exact_sum(value: Column, scale: int = SCALE) -> Column:
    """Aggregate: the sum as a double; NULL without a value. Values below 10**38 in size, up to 10**13 of them."""
    whole = value.cast("decimal(38,0)")
    rest = (value - whole.cast("double")).cast(f"decimal(38,{scale})")
    return F.sum(whole).cast("double") + F.sum(rest).cast("double")


def exact_deviation(value: Column, scale: int = SCALE) -> Column:
    """Aggregate: the sample deviation from the sums of the values and of their squares; NULL for fewer than two."""
    n, total = F.count(value), exact_sum(value, scale)
    variance = (exact_sum(value * value, scale) - total * total / F.nullif(n, F.lit(0))) / F.nullif(n - 1, F.lit(0))
    return F.when(n > 1, F.sqrt(F.greatest(variance, F.lit(0.0))))
