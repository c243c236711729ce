"""Exact quantiles without gathering a column in one place.

A double has a 64-bit whole number that stands in the same order. The number is read 16 bits
at a time, the upper ones first: a pass counts the values by these bits among those whose upper
bits are known to be a wanted rank's, and a running total over the counts names the bits that
hold it. After four passes a single value is left, whatever the values are and however far some
of them lie out. Each pass moves at most 65,536 rows per task and rank.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BITS = 16
_MANTISSA, _BIAS = 52, 1023


def ordered_bits(value: Column) -> Column:
    """The value's place in the order of doubles as a signed long, both zeros at 0; not for NaN.

    It is made of the exponent and the mantissa, which arithmetic by powers of two gives exactly.
    """
    size = F.abs(value)
    guess = F.greatest(F.floor(F.log2(size)), F.lit(1 - _BIAS))
    low = F.when(F.pow(F.lit(2.0), guess) > size, guess - 1).otherwise(guess)
    # the logarithm may be off by one where a value is next to a power of two
    exponent = F.when(size / F.pow(F.lit(2.0), low) >= 2, low + 1).otherwise(low)
    exponent = F.greatest(exponent, F.lit(1 - _BIAS))
    scaled = size / F.pow(F.lit(2.0), exponent)
    mantissa = F.when(scaled >= 1, scaled - 1).otherwise(scaled) * F.lit(float(1 << _MANTISSA))
    above = F.when(scaled >= 1, exponent + _BIAS).otherwise(0).cast("long")
    bits = F.shiftleft(above, _MANTISSA) + mantissa.cast("long")
    bits = F.when(size == 0, F.lit(0).cast("long")).otherwise(bits)
    bits = F.when(size == float("inf"), F.lit(2047 << _MANTISSA).cast("long")).otherwise(bits)
    return F.when(value < 0, -bits).otherwise(bits)


def exact_quantiles(
    frame: DataFrame, columns: Sequence[str], fraction: float, bits: int = BITS
) -> DataFrame:
    """One row (name, quantile) per column, interpolating linearly between ranks.

    Nulls and NaN are left out; a column without values gives no row. ``bits`` are read in a pass.
    """
    pairs = [
        F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in columns
    ]
    values = frame.select(F.inline(F.array(*pairs)))
    values = values.where(F.col("value").isNotNull() & ~F.isnan("value"))
    values = values.select("name", "value", ordered_bits(F.col("value")).alias("bits"))
    ranks = None
    for shift in range(64 - bits, -bits, -bits):
        ranks = _narrowed(values, ranks, max(shift, 0), fraction)
    low, high = F.min_by("least", "rank"), F.max_by("least", "rank")
    weight = F.max(F.col("position") - F.floor("position"))
    # between equal infinities there is nothing to weigh
    quantile = F.when(low == high, low).otherwise(low + weight * (high - low))
    return ranks.groupBy("name").agg(quantile.alias("quantile"))


def _narrowed(
    values: DataFrame, ranks: DataFrame | None, shift: int, fraction: float
) -> DataFrame:
    """``name, rank, position, before, upper, least``: the bits down to ``shift`` that hold each rank.

    ``before`` values come ahead of those that have them, ``least`` is the smallest that has.
    """
    place = F.shiftright("bits", shift)
    sums = [F.count(F.lit(1)).alias("n"), F.min("value").alias("least")]
    if ranks is None:
        counts = values.groupBy("name", place.alias("upper")).agg(*sums)
        position = (F.sum("n").over(Window.partitionBy("name")) - 1) * F.lit(float(fraction))
        running = F.sum("n").over(Window.partitionBy("name").orderBy("upper")) - F.col("n")
        placed = counts.select("*", position.alias("position"), running.alias("before"))
        both = F.array_distinct(F.array(F.floor("position"), F.ceil("position")))
        placed = placed.select("*", F.explode(both).alias("rank"))
    else:
        # one row per column and rank: a bounded side
        known = ranks.select("name", "rank", "position", "before", "upper", "shift")
        near = values.join(F.broadcast(known.withColumnRenamed("upper", "_upper")), "name")
        near = near.where(F.expr("shiftright(bits, shift)") == F.col("_upper"))
        counts = near.groupBy("name", "rank", "position", "before", place.alias("upper")).agg(*sums)
        own = Window.partitionBy("name", "rank").orderBy("upper")
        running = F.col("before") + F.sum("n").over(own) - F.col("n")
        placed = counts.withColumn("before", running)
    held = F.col("rank").between(F.col("before"), F.col("before") + F.col("n") - 1)
    return placed.where(held).select(
        "name", "rank", "position", "before", "upper", "least", F.lit(shift).alias("shift")
    )


def exact_quantile(frame: DataFrame, column: str, fraction: float) -> DataFrame:
    """One row, one column ``quantile``."""
    quantiles = exact_quantiles(frame, [column], fraction)
    return quantiles.agg(F.max("quantile").alias("quantile"))
