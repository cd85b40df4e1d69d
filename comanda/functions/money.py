"""Exact sums and half-up means.

Amounts are stored as doubles with a fixed number of decimals. Adding them as whole units (cents for
money, hundredths of a km) gives the same total for any partitioning, and keeps sums in 64-bit codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WIDE = "decimal(38,0)"


def units(col: Column | str, per_one: int = 100) -> Column:
    """The amount in whole units, e.g. cents. ``rint`` only removes the binary error of the product."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("bigint") if per_one == 1 else F.rint(c.cast("double") * per_one).cast("bigint")


def half_up(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator rounded half away from zero, as whole number; NULL for denominator 0.

    This runs on aggregated rows, so it can afford decimals: a scaled total may be beyond 64 bits.
    """
    num, den = numerator.cast(WIDE), F.nullif(denominator.cast(WIDE), F.lit(0).cast(WIDE))
    magnitude = F.call_function("div", F.abs(num) * 2 + den, den * 2)
    return F.when(num < 0, -magnitude).otherwise(magnitude)


def amount(whole: Column, per_one: int = 100) -> Column:
    """Whole units back as a double, also where the units exceed the 53 bits of a double."""
    return (whole.cast(WIDE) / per_one).cast("double")


def exact_sum(col: Column | str, per_one: int = 100) -> Column:
    return amount(F.sum(units(col, per_one)), per_one)


def exact_mean(col: Column | str, digits: int, per_one: int = 100) -> Column:
    """AVG(col) rounded to ``digits``; NULLs are not counted."""
    scale = 10**digits
    c = units(col, per_one)
    return amount(half_up(F.sum(c).cast(WIDE) * scale, F.count(c) * per_one), scale)


def pct_change(value: Column, previous: Column) -> Column:
    """Change against the previous value in percent, 2 digits; NULL without or with zero predecessor."""
    return F.round(F.try_divide(value - previous, previous) * 100, 2)
