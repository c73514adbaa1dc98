"""Draws that depend on nothing but a phrase, so a retried task draws the same.

Phrase to seeds, the combined multiplicative generator of L'Ecuyer (1988), and
the normal deviate of Ahrens and Dieter (1973, algorithm FL with five bits).
The tables of that algorithm have closed forms and are computed here.
"""

from __future__ import annotations

import math
from functools import lru_cache
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Moduli and multipliers of the generator, its scale, and the multipliers of phrases.
MODULI, MULTIPLIERS, SCALE = (2147483563, 2147483399), (40014, 40692), 4.65661305739177e-10
PHRASE_MULTIPLIERS = (8521739, 5266711, 3254959, 2011673, 1243273, 768389, 474899, 293507)
FIRST_SEEDS, SEED_MODULUS = (1234567890, 123456789), 2**30


def seeds_of(phrase: bytes) -> tuple[int, int]:
    """Two seeds of a phrase; trailing blanks and the last character before them do not count."""
    one, two = FIRST_SEEDS
    for i, byte in enumerate(phrase.rstrip(b" ")[:-1]):
        value = byte - 256 if byte > 127 else byte
        one = int(math.fmod(one + PHRASE_MULTIPLIERS[i % 8] * value, SEED_MODULUS))
        two = int(math.fmod(two + PHRASE_MULTIPLIERS[7 - i % 8] * value, SEED_MODULUS))
    return one, two


class Uniform:
    """Uniform deviates over (0, 1) from two seeds."""

    def __init__(self, seeds: tuple[int, int]):
        self.seeds = seeds

    def __call__(self) -> float:
        self.seeds = tuple(s * a % m for s, a, m in zip(self.seeds, MULTIPLIERS, MODULI))
        z = self.seeds[0] - self.seeds[1]
        return (z if z >= 1 else z + MODULI[0] - 1) * SCALE


@lru_cache(maxsize=1)
def _tables() -> tuple[list[float], list[float], list[float], list[float]]:
    inverse = NormalDist().inv_cdf
    start = [inverse(0.5 + i / 64) for i in range(32)]
    width = [b - a for a, b in zip(start, start[1:])]
    test = [(w / 2 + a) * w for a, w in zip(start, width)]
    ratio = [w / (1 - t) for w, t in zip(width, test)]
    edge = [-inverse(2.0**-i) for i in range(6, 64)]
    return start, test, ratio, [b - a for a, b in zip(edge, edge[1:])]


def normal(uniform: Uniform) -> float:
    """One standard normal deviate."""
    start, test, ratio, tail = _tables()
    u = uniform()
    negative = u > 0.5
    u = 32 * (2 * u - negative)
    cell = min(int(u), 31)
    if cell:
        low, star = start[cell], u - cell
        size = _center(uniform, start, test, ratio, cell, low, star)
    else:
        size = _tail(uniform, start[31], tail, u)
    return -size if negative else size


def _accepted(uniform: Uniform, limit: float, star: float) -> tuple[bool, float]:
    """Comparison of ever new deviates; whether the run ends at once above the limit, and the last one drawn."""
    while star <= limit:
        u = uniform()
        if star < u:
            return False, u
        limit, star = u, uniform()
    return True, star


def _center(uniform: Uniform, start: list, test: list, ratio: list, cell: int, low: float, star: float) -> float:
    # Cell i lies between start[i] and start[i + 1]; the tables of tests count from cell 1.
    i = cell - 1
    low, high = start[i], start[i + 1]
    while star <= test[i]:
        w = uniform() * (high - low)
        if _accepted(uniform, (w / 2 + low) * w, star)[0]:
            return low + w
        star = uniform()
    return low + (star - test[i]) * ratio[i]


def _tail(uniform: Uniform, low: float, tail: list, u: float) -> float:
    i = 0
    while (u := 2 * u) < 1:
        low += tail[i]
        i += 1
    u -= 1
    while True:
        w = u * tail[i]
        if _accepted(uniform, (w / 2 + low) * w, uniform())[0]:
            return low + w
        u = uniform()


def normal_of(phrase: bytes, mean: float, sd: float) -> float:
    """First normal deviate of a phrase."""
    if sd < 0:
        raise ValueError("a standard deviation cannot be negative")
    return sd * normal(Uniform(seeds_of(phrase))) + mean


def first_normals(phrases: np.ndarray) -> np.ndarray:
    """First standard normal deviate of each row of 32 ASCII characters.

    Most deviates are settled by the first uniform one; those are computed for
    all rows together, the others one by one.
    """
    start, test, ratio, _ = map(np.array, _tables())
    used = phrases[:, :31].astype(np.int64)
    weights = np.array([[PHRASE_MULTIPLIERS[i % 8], PHRASE_MULTIPLIERS[7 - i % 8]] for i in range(31)], dtype=np.int64)
    seeds = (used @ weights + np.array(FIRST_SEEDS)) % SEED_MODULUS
    z = seeds[:, 0] * MULTIPLIERS[0] % MODULI[0] - seeds[:, 1] * MULTIPLIERS[1] % MODULI[1]
    u = np.where(z >= 1, z, z + MODULI[0] - 1) * SCALE
    negative = u > 0.5
    u = 32 * (2 * u - negative)
    cell = np.minimum(u.astype(np.int64), 31)
    i = np.maximum(cell - 1, 0)
    over = u - cell - test[i]
    size = start[i] + over * ratio[i]
    out = np.where(negative, -size, size)
    for k in np.flatnonzero((cell == 0) | (over <= 0)):
        out[k] = normal(Uniform((int(seeds[k, 0]), int(seeds[k, 1]))))
    return out


def half_draw(text: Column, mean: Column, sd: Column) -> Column:
    """Half a normal draw seeded by the MD5 of the text, rounded half to even and never below 0; null for a null text."""

    @F.pandas_udf(T.LongType())
    def drawn(phrases: pd.Series, means: pd.Series, sds: pd.Series) -> pd.Series:
        if (sds < 0).any():
            raise ValueError("a standard deviation cannot be negative")
        digits = np.frombuffer("".join(phrases).encode(), dtype=np.uint8).reshape(-1, 32)
        draws = sds.to_numpy() * first_normals(digits) + means.to_numpy()
        return pd.Series(np.maximum(0, np.rint(draws / 2)).astype("int64"))

    known = F.coalesce(F.md5(text), F.lit("0" * 32))
    return F.when(text.isNotNull(), drawn(known, F.coalesce(mean, F.lit(0)).cast("double"), F.coalesce(sd, F.lit(0)).cast("double")))
