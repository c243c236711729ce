"""Order-independent means.

A floating-point sum depends on the order rows arrive in, and so would a rounded
mean after a shuffle. Doubles are scaled to integer millionths, whose sums are
exact, merge across stages, and stay in a primitive hash-aggregate buffer; digits
past the sixth are dropped. Integers are summed as they are.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SCALE = 1_000_000


def to_micro(value: Column) -> Column:
    """Millionths of a double; NaN, infinities and what does not fit count as null."""
    return F.round(value * F.lit(float(_SCALE))).try_cast("bigint")


def mean_of_micro(total: Column, count: Column, places: int = 2) -> Column:
    """Mean from a sum of millionths, rounded half up; null when nothing was counted."""
    mean = F.when(count > 0, total / count / F.lit(float(_SCALE)))
    return F.round(mean.cast("decimal(24,10)"), places).cast("double")


def exact_mean(value: Column, places: int = 2) -> Column:
    """Aggregate: mean of a double rounded half up to ``places``."""
    micro = to_micro(value)
    return mean_of_micro(F.sum(micro), F.count(micro), places)


def integer_mean(value: Column, places: int = 2) -> Column:
    """Aggregate: mean of an integer column rounded half up to ``places``."""
    mean = F.try_divide(F.sum(value.cast("decimal(20,0)")), F.count(value))
    return F.round(mean.cast("decimal(38,10)"), places).cast("double")
