"""Differences between two copies of a table, field by field."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Hash buckets for each of the session's shuffle partitions.
BUCKETS = 8


def bare_name(c: Column) -> Column:
    """Name before a `::` suffix, without surrounding blanks."""
    return F.trim(F.split_part(c, F.lit("::"), F.lit(1)))


def newest(df: DataFrame, key: list[str], values: list[str], version: list[str]) -> DataFrame:
    """One row for each key: the values of the greatest version (null lowest; of equals the greatest values).

    The aggregate runs in part before its shuffle, so a key that holds a third
    of all rows sends one row from each task.
    """
    row = F.max(F.struct(*version, *[F.col(v) for v in values if v not in version])).alias("__row")
    return df.groupBy(*key).agg(row).select(*key, *[F.col(f"__row.`{v}`").alias(v) for v in values])


def _codes(left: pa.Table, right: pa.Table, key: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Integers that are equal exactly where the keys are; null is a key like any other."""
    code = np.zeros(len(left) + len(right), dtype=np.int64)
    for k in key:
        both = pa.chunked_array(left.column(k).chunks + right.column(k).chunks, left.schema.field(k).type).combine_chunks()
        coded = both.dictionary_encode(null_encoding="encode")
        coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
        code = np.unique(code * (len(coded.dictionary) + 1) + coded.indices.to_numpy(zero_copy_only=False), return_inverse=True)[1]
    return code[: len(left)], code[len(left) :]


def _differs(x: pa.ChunkedArray, y: pa.ChunkedArray, tolerance: float) -> np.ndarray:
    """Null-aware mask: null equals only null, NaN only NaN, an infinity only itself."""
    no_x, no_y = (v.is_null().to_numpy(zero_copy_only=False) if isinstance(v, pa.Array) else v.is_null().combine_chunks().to_numpy(zero_copy_only=False) for v in (x, y))
    if not pa.types.is_floating(x.type):
        unequal = pc.fill_null(pc.not_equal(x, y), False).combine_chunks().to_numpy(zero_copy_only=False)
        return unequal | (no_x != no_y)
    a, b = (pc.fill_null(v, 0.0).combine_chunks().to_numpy(zero_copy_only=False).astype(np.float64) for v in (x, y))
    with np.errstate(invalid="ignore", over="ignore"):
        near = np.isfinite(a) & np.isfinite(b) & ~(np.abs(a - b) > tolerance * np.maximum(np.abs(a), np.abs(b)))
    same = near | (a == b) | np.isnan(a) & np.isnan(b)
    return (no_x != no_y) | ~no_x & ~no_y & ~same


def differences(
    left: DataFrame,
    right: DataFrame,
    key: list[str],
    values: list[str],
    version: list[str] | None = None,
    tolerance: float = 1e-9,
    only: tuple[str, str] = ("only_left", "only_right"),
    buckets: int | None = None,
) -> DataFrame:
    """key, what, left_value, right_value: rows missing on either side and values that differ.

    The newest row of each key counts (see newest; without version columns, the
    row of greatest values).  what is one of `only` where the other side has no
    such key, otherwise the name of a value that differs, with both values as
    text.  Numbers differ by more than `tolerance` of the larger one; other
    types by equality.  Nulls are keys and values like others.  Empty tables
    and repeated rows are fine; columns beyond those named are not read.

    Both sides are cogrouped by a hash bucket of the key.  There are as many
    buckets as the session's shuffle partitions ask for, so that a bucket's
    Arrow tables are a small part of what a task is meant to hold, and neither
    table has to be counted first.
    """
    # New names for the columns: cogroup mixes them up where one side derives from the other.
    sides = [newest(df, key, values, version or []).select(*[F.col(f"`{c}`").alias(c) for c in [*key, *values]]) for df in (left, right)]
    if buckets is None:
        buckets = BUCKETS * int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grouped = [s.withColumn("__bucket", F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")).groupBy("__bucket") for s in sides]
    fields = [sides[0].schema[k] for k in key] + [T.StructField(n, T.StringType()) for n in ("what", "left_value", "right_value")]

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        x, y = _codes(a, b, key)
        order = np.argsort(y)
        at = np.searchsorted(y[order], x)
        found = at < len(y)
        found[found] = y[order][at[found]] == x[found]
        l_both, r_both = np.flatnonzero(found), order[at[found]]
        l_only = np.flatnonzero(~found)
        r_only = np.setdiff1d(np.arange(len(y)), r_both, assume_unique=True)
        a, b = a.combine_chunks(), b.combine_chunks()
        parts = []

        def emit(keys: pa.Table, rows: np.ndarray, what: str, was: pa.Array | None = None, now: pa.Array | None = None) -> None:
            if len(rows):
                columns = [keys.column(k).take(pa.array(rows)) for k in key]
                empty = pa.nulls(len(rows), pa.string())
                said = [empty if v is None else pc.cast(v, pa.string()) for v in (was, now)]
                parts.append(pa.table([*columns, pa.array([what] * len(rows), pa.string()), *said], names=[*key, "what", "left_value", "right_value"]))

        emit(a, l_only, only[0])
        emit(b, r_only, only[1])
        for v in values:
            u, w = a.column(v).take(pa.array(l_both)), b.column(v).take(pa.array(r_both))
            mask = pa.array(_differs(u, w, tolerance)) if len(l_both) else pa.array([], pa.bool_())
            emit(a, l_both[mask.to_numpy(zero_copy_only=False)], v, u.filter(mask), w.filter(mask))
        if parts:
            return pa.concat_tables(parts)
        return pa.table({k: pa.array([], a.schema.field(k).type) for k in key} | {n: pa.array([], pa.string()) for n in ("what", "left_value", "right_value")})

    return grouped[0].cogroup(grouped[1]).applyInArrow(run, T.StructType(fields))
