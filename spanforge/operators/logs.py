"""Summaries of append-only logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_entries(df: DataFrame, keys: list[str], value: str, ord: str) -> DataFrame:
    """keys, value, first: the last value of each key, and where the key was first seen."""
    return df.groupBy(*keys).agg(F.max_by(value, ord).alias(value), F.min(ord).alias("first"))


def trim_summary(df: DataFrame, by: str, kind: str = "kind", reads: str = "reads") -> DataFrame:
    """by, total_reads, filtered_reads, files, remaining_reads, percent_filtered from rows of kinds `total` and `discarded`."""
    total, gone = (F.coalesce(F.sum(F.when(F.col(kind) == k, F.col(reads))), F.lit(0)) for k in ("total", "discarded"))
    sums = df.groupBy(by).agg(total.alias("total_reads"), gone.alias("filtered_reads"), F.count(F.when(F.col(kind) == "total", 1)).alias("files"))
    return sums.select(
        "*", F.greatest(F.col("total_reads") - F.col("filtered_reads"), F.lit(0)).alias("remaining_reads"),
        share(F.col("filtered_reads"), F.col("total_reads")).alias("percent_filtered"),
    )


def share(part: Column, whole: Column) -> Column:
    """part / whole, 0 where there is no whole."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(F.try_divide(part.cast("double"), whole.cast("double")))


def percent_aligned(aligned: Column, remaining: Column) -> Column:
    """Null where either is unknown or nothing remained."""
    return F.try_divide(aligned.cast("double"), remaining.cast("double"))


def survival(pairs_in: Column, pairs_out: Column) -> Column:
    """no_input, none, low (under half) or ordinary."""
    return F.when(pairs_in == 0, "no_input").when(pairs_out == 0, "none").when(pairs_out * 2 < pairs_in, "low").otherwise("ordinary")


def distinct_names(lines: DataFrame, by: list[str], line: str = "value") -> DataFrame:
    """by, names: different fourth fields of tab-separated lines; a shorter line has an empty one. Exact."""
    name = F.coalesce(F.get(F.split(line, "\t"), F.lit(3)), F.lit(""))
    return lines.groupBy(*by).agg(F.countDistinct(name).alias("names"))


def total(reads: str) -> Column:
    """Sum of a 64-bit column that may go beyond 64 bits."""
    return F.sum(F.col(reads).cast("decimal(20,0)")).cast("decimal(38,0)")


def expected_reads(df: DataFrame, sample: str, reads: str) -> DataFrame:
    """sample, expected: reads over both mates (decimal), null for none."""
    return df.groupBy(sample).agg(F.nullif(total(reads), F.lit(0).cast("decimal(38,0)")).alias("expected"))


def expected_halves(df: DataFrame, sample: str, reads: str) -> DataFrame:
    """sample, expected_pairs (decimal), expected_files: whole halves, as both mates are listed."""
    sums = df.groupBy(sample).agg(F.coalesce(total(reads), F.lit(0)).alias("__t"), F.expr("count(*) div 2").alias("expected_files"))
    return sums.select(sample, ((F.col("__t") - F.col("__t") % 2) / 2).cast("decimal(38,0)").alias("expected_pairs"), "expected_files")


def sample_report(names: DataFrame, sample: str, summary: DataFrame, aligned: DataFrame, **sets: DataFrame) -> DataFrame:
    """Every sample with its summary (zeros if none), aligned count (null if none) and membership in each of `sets`."""
    out = names.join(summary, sample, "left").join(aligned, sample, "left")
    out = out.fillna(0, [c for c in summary.columns if c != sample])
    for name, members in sets.items():
        mark = members.select(sample).distinct().withColumn(f"in_{name}", F.lit(True))
        out = out.join(mark, sample, "left").withColumn(f"in_{name}", F.coalesce(f"in_{name}", F.lit(False)))
    return out


def largest_relative_error(a: DataFrame, b: DataFrame, key: list[str], value: str) -> DataFrame:
    """One row: rows compared, rows only on one side, and the largest relative difference."""
    x, y = a.select(*key, F.col(value).alias("__x"), F.lit(1).alias("__l")), b.select(*key, F.col(value).alias("__y"), F.lit(1).alias("__r"))
    met = x.join(y, key, "full")
    both = F.col("__l").isNotNull() & F.col("__r").isNotNull()
    error = F.try_divide(F.abs(F.col("__x") - F.col("__y")), F.greatest(F.abs("__x"), F.abs("__y")))
    return met.agg(F.count(F.when(both, 1)).alias("compared"), F.count(F.when(~both, 1)).alias("alone"), F.coalesce(F.max(error), F.lit(0.0)).alias("error"))
