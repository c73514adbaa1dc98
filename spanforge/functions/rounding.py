"""Rounding to a number of decimals the way R 4 does it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_r(x: Column, digits: int = 2) -> Column:
    """The nearer of the two neighbouring decimals; of equally near ones, the one whose last digit is even.

    Null, NaN and infinite values stay as they are, as do values with too many
    digits before the point for the decimals to matter.
    """
    scale = F.lit(float(10**digits))
    size = F.abs(x.cast("double"))
    low, high = F.floor(size * scale), F.ceil(size * scale)
    below, above = low / scale, high / scale
    up = (above - size < size - below) | ((above - size == size - below) & (F.pmod(low, F.lit(2)) == 1))
    rounded = F.when(up, above).otherwise(below) * F.when(x < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
    plain = F.isnan(x) | (size * scale >= F.lit(float(2**52)))
    return F.when(plain, x.cast("double")).otherwise(rounded)


def round_half_even(x: Column) -> Column:
    """Nearest integer, halves to the even one."""
    return F.rint(x).cast("long")
