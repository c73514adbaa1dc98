"""Numbers as text in the spellings of C, awk and R; for sinks only."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _each(spell):
    @F.pandas_udf(T.StringType())
    def spelled(values: pd.Series) -> pd.Series:
        return values.map(spell)

    return lambda x: F.when(x.isNotNull(), spelled(x))  # pandas shows a null number as NaN


def awk_text(v: float, precision: int = 6) -> str:
    """Integral values as integers, others in at most `precision` significant digits."""
    if math.isfinite(v) and v == int(v) and abs(v) < 1e16:
        return str(int(v))
    return f"%.{precision}g" % v


def r_text(v: float, digits: int = 15) -> str:
    """Fewest digits, at most `digits`, that give the same value at that precision; fixed unless scientific is shorter."""
    if math.isnan(v):
        return "NaN"
    if math.isinf(v):
        return "Inf" if v > 0 else "-Inf"
    if v == 0:
        return "0"
    goal = float(f"%.{digits - 1}e" % v)
    need = next((d for d in range(1, digits + 1) if float(f"%.{d - 1}e" % v) == goal), digits)
    science = f"%.{need - 1}e" % v
    exponent = int(science.split("e")[1])
    fixed = f"%.{max(0, need - 1 - exponent)}f" % v
    return fixed if len(fixed) <= len(science) else science


def as_awk(x: Column, precision: int = 6) -> Column:
    """awk's print of a number; null stays null."""
    return _each(lambda v: awk_text(float(v), precision))(x.cast("double"))


def as_general(x: Column, digits: int = 15) -> Column:
    """C's %.{digits}g."""
    return _each(lambda v: f"%.{digits}g" % v)(x.cast("double"))


def as_r(x: Column, digits: int = 15) -> Column:
    """R's spelling in a written table."""
    return _each(lambda v: r_text(float(v), digits))(x.cast("double"))
