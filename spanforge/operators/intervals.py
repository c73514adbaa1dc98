"""Overlap joins, merging and ordering of half-open intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from spanforge.checkpoints import cut

#: Width of the position bins of the overlap join, in mean lengths of the intervals of its first side.
BIN_LENGTHS = 1


def overlap_length(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """Positions that two intervals share; 0 if they do not overlap or either is null."""
    shared = F.least(a_end, b_end) - F.greatest(a_start, b_start)
    return F.when(b_start.isNull() | a_start.isNull(), F.lit(0).cast("long")).otherwise(F.greatest(shared, F.lit(0).cast("long")))


def _sound(start: str, end: str) -> Column:
    """Not empty, not reversed, and with both bounds."""
    return F.col(start).isNotNull() & F.col(end).isNotNull() & (F.col(start) < F.col(end))


def bin_width(df: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """One row, __width: bins so wide that the intervals of df touch two of them on average, or somewhat less.

    The mean decides, so a few intervals of any length are no exception to
    that.  Those of the other side that touch many bins are as long as many
    intervals of df.  Wider bins would make more pairs meet that do not overlap.
    """
    mean = F.avg(F.when(_sound(start, end), F.col(end) - F.col(start)))
    return df.agg(F.coalesce(F.ceil(BIN_LENGTHS * mean), F.lit(1)).cast("long").alias("__width"))


def _binned(df: DataFrame, start: str, end: str, width: DataFrame) -> DataFrame:
    """One row for each bin that an interval touches; empty and reversed intervals and null bounds touch none."""
    first, last = F.expr(f"`{start}` div __width"), F.expr(f"(`{end}` - 1) div __width")
    sound = df.where(_sound(start, end)).crossJoin(F.broadcast(width))
    return sound.withColumn("__first", first).withColumn("__bin", F.explode(F.sequence(first, last))).drop("__width")


def _renamed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").alias(prefix + c) for c in df.columns])


def overlap_inner(
    a: DataFrame, b: DataFrame, chrom: str = "chrom", start: str = "start", end: str = "end", width: int | None = None, prefixes: tuple[str, str] = ("a_", "b_")
) -> DataFrame:
    """Pairs of overlapping intervals: all columns of both with a prefix, and `overlap`.

    Equi-join on chromosome and position bin, so a chromosome that holds a third
    of all rows is spread over its bins and skewed bins can be split at run
    time.  A pair is kept only in the later of the two first bins, hence once.
    The width of the bins follows from the intervals of `a` (see bin_width)
    unless one is given.
    """
    pa_, pb = prefixes
    wide = bin_width(a, start, end) if width is None else a.sparkSession.range(1).select(F.lit(width).cast("long").alias("__width"))
    x = _binned(_renamed(a, pa_), pa_ + start, pa_ + end, wide).withColumnRenamed("__first", "__a_first")
    y = _binned(_renamed(b, pb), pb + start, pb + end, wide).withColumnRenamed("__first", "__b_first").withColumnRenamed("__bin", "__b_bin")
    met = x.join(y, (F.col(pa_ + chrom) == F.col(pb + chrom)) & (F.col("__bin") == F.col("__b_bin")))
    length = overlap_length(F.col(pa_ + start), F.col(pa_ + end), F.col(pb + start), F.col(pb + end))
    met = met.where(F.col("__bin") == F.greatest("__a_first", "__b_first")).withColumn("overlap", length).where("overlap > 0")
    return met.drop("__bin", "__b_bin", "__a_first", "__b_first")


def overlap_left(
    a: DataFrame, b: DataFrame, chrom: str = "chrom", start: str = "start", end: str = "end", width: int | None = None, prefixes: tuple[str, str] = ("a_", "b_")
) -> DataFrame:
    """Like overlap_inner, with every interval of `a` that meets none given once with nulls and overlap 0.

    Book-ended intervals do not meet.  Whether an interval meets any depends on
    its place alone, so what is left over is found by its place: repeated rows
    of `a` stay repeated.
    """
    met = overlap_inner(a, b, chrom, start, end, width, prefixes)
    place = [prefixes[0] + c for c in (chrom, start, end)]
    alone = _renamed(a, prefixes[0]).join(met.select(*place).distinct(), place, "left_anti")
    nulls = [F.lit(None).cast(t).alias(prefixes[1] + c) for c, t in b.dtypes]
    return met.unionByName(alone.select("*", *nulls, F.lit(0).cast("long").alias("overlap")))


def overlap_sums(
    a: DataFrame, b: DataFrame, name: str = "name", chrom: str = "chrom", start: str = "start", end: str = "end", width: int | None = None
) -> DataFrame:
    """name, chrom, start, end, overlap_sum for each row of `a`: positions that `b` covers, counted once for each of its rows.

    Rows of `b` at one place are counted before the join, and sums are taken in
    part before the last shuffle.
    """
    counted = b.groupBy(chrom, start, end).agg(F.count("*").alias("__n"))
    places = a.select(chrom, start, end).distinct()
    met = overlap_inner(places, counted, chrom, start, end, width)
    sums = met.groupBy(*[F.col("a_" + c).alias(c) for c in (chrom, start, end)]).agg(F.sum(F.col("overlap") * F.col("b___n")).alias("__sum"))
    named = a.select(name, chrom, start, end)
    return named.join(sums, [chrom, start, end], "left").select(name, chrom, start, end, F.coalesce("__sum", F.lit(0)).cast("long").alias("overlap_sum"))


def depth(overlap_sum: Column, start: Column, end: Column) -> Column:
    """Covered positions over the length plus one; the plus one is part of the definition."""
    return F.try_divide(overlap_sum.cast("double"), (end - start + 1).cast("double"))


def merge_sum(df: DataFrame, key: str = "key", start: str = "start", end: str = "end", value: str = "value") -> DataFrame:
    """key, start, end, value: intervals of a key that overlap or touch become one, their values summed.

    Equal intervals are summed first, in part before the shuffle; a key whose
    rows all share one interval then has a single row to look at.  A window goes
    through the rest of a key's rows in one task; for keys that hold a large
    share of all rows see stretches.stretch_sums.  Rows with null bounds are
    left out; null values count as none.
    """
    sums = (
        df.where(F.col(start).isNotNull() & F.col(end).isNotNull()).groupBy(key, start, end).agg(F.coalesce(F.sum(value), F.lit(0)).alias("__value"))
    )
    order = W.partitionBy(key).orderBy(start, end)
    reach = F.max(end).over(order.rowsBetween(W.unboundedPreceding, -1))
    opened = sums.withColumn("__opens", F.when(F.col(start) <= reach, 0).otherwise(1))
    island = opened.withColumn("__island", F.sum("__opens").over(order.rowsBetween(W.unboundedPreceding, 0)))
    return (
        island.groupBy(key, "__island").agg(F.min(start).alias(start), F.max(end).alias(end), F.sum("__value").alias(value)).drop("__island")
    )


def check_contiguous(df: DataFrame, key: str, start: str, order: str) -> DataFrame:
    """df, failing at run time where, in the given order, a key comes back after another or a start goes back within its key."""
    by_key = W.partitionBy(key).orderBy(order)
    bounds = df.groupBy(key).agg((F.max(order) - F.min(order) + 1).alias("__span"), F.count("*").alias("__rows"))
    back = F.lag(start).over(by_key) > F.col(start)
    seen = df.withColumn("__back", F.coalesce(back, F.lit(False))).join(bounds, key)
    bad = F.when(F.col("__span") != F.col("__rows"), F.raise_error(F.lit("a key comes back after another"))).when(
        F.col("__back"), F.raise_error(F.lit("a start goes back within its key"))
    )
    return seen.where(bad.cast("string").isNull()).drop("__back", "__span", "__rows")


def bed_line(*columns: str) -> Column:
    return F.concat_ws("\t", *[F.col(c).cast("string") for c in columns])


def in_total_order(df: DataFrame, chrom: str = "chrom", start: str = "start", line: Column | None = None) -> DataFrame:
    """Rows by chromosome (bytes), start (number) and, last, the whole line."""
    whole = line if line is not None else bed_line(*df.columns)
    return df.withColumn("__line", whole).orderBy(chrom, start, "__line").drop("__line")


def placed_in_total_order(df: DataFrame, chrom: str = "chrom", start: str = "start", line: Column | None = None) -> DataFrame:
    """All columns of df and `place`, from 1, in the order of in_total_order.

    Rows are sorted in ranges, written to the checkpoint folder and numbered
    from the sizes of the ranges before, a row for each.
    """
    whole = line if line is not None else bed_line(*df.columns)
    keys = [chrom, start, "__line"]
    ranged = df.withColumn("__line", whole).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("__line")
    found = cut(ranged.withColumn("__range", F.spark_partition_id()).withColumn("__id", F.monotonically_increasing_id()))
    sizes = found.groupBy("__range").agg(F.count("*").alias("__n"), F.min("__id").alias("__first"))
    before = F.coalesce(F.sum("__n").over(W.orderBy("__range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = F.broadcast(sizes.select("__range", (before - F.col("__first") + 1).alias("__add")))  # a row for each range
    return found.join(offsets, "__range").withColumn("place", F.col("__id") + F.col("__add")).drop("__range", "__id", "__add")


def text_number(x: Column) -> Column:
    """A decimal number in a text, 0 for text that is none, for sorting by value."""
    return F.coalesce(x.try_cast("decimal(38,18)"), F.lit(0).cast("decimal(38,18)"))
