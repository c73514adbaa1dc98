"""Continuous stretches of overlapping intervals, and the gaps between them.

The k-th least start of an entity and its k-th least end are found
independently.  A gap lies behind the k-th end exactly where the start of rank
k + 1 is greater.  Ranks are global per entity, but no task ever sorts an
entity: starts and ends are first counted per position, ranked within blocks of
positions, and raised by the counts of the blocks before.  Starts and ends then
meet in one aggregate by rank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from spanforge.checkpoints import cut

#: Rows of a block, were all of one entity, and most blocks of an entity: the width of a block follows from the data.
BLOCK_ROWS, MOST_BLOCKS = 1_000_000, 1 << 20


def usable_intervals(df: DataFrame, entity: list[str], start: str, end: str) -> DataFrame:
    """Rows with an entity and an end beyond their start."""
    there = [F.col(c).isNotNull() for c in [*entity, start, end]]
    condition = F.col(start) < F.col(end)
    for t in there:
        condition = condition & t
    return df.where(condition)


def bare_chrom(c: Column) -> Column:
    """Chromosome with the prefix `chr`, whatever its case or blanks around it."""
    return F.concat(F.lit("chr"), F.regexp_replace(F.trim(c), "^(?i)chr", ""))


def block_width(df: DataFrame, low: str, high: str) -> DataFrame:
    """One row, __width: positions to a block, for windows over blocks of at most MOST_BLOCKS rows.

    The middle 98 % of the positions are cut into as many blocks as the number
    of rows asks for, whatever the unit of the positions; a few far ones only
    make the blocks wider where there would be too many otherwise.
    """
    sums = df.agg(
        F.percentile_approx(low, 0.01, 1000).alias("a"), F.percentile_approx(high, 0.99, 1000).alias("b"), F.min(low).alias("c"), F.max(high).alias("d"),
        F.least(F.ceil(F.count("*") / BLOCK_ROWS), F.lit(MOST_BLOCKS)).alias("n"),
    )
    parts = [F.ceil((F.col(y).cast("double") - F.col(x).cast("double")) / F.greatest(n, F.lit(1))) for x, y, n in (("a", "b", F.col("n")), ("c", "d", F.lit(MOST_BLOCKS)))]
    return sums.select(F.coalesce(F.greatest(*parts, F.lit(1)), F.lit(1)).cast("long").alias("__width"))


def _running(df: DataFrame, entity: list[str], position: str, amounts: dict[str, Column], width: DataFrame) -> DataFrame:
    """entity, position and, of each amount, x_before, x_upto, x_whole: its sums over the rows of an entity before each position, with it, and over all.

    The sums per block come from the sums per position, not from the rows.
    """
    counted = df.groupBy(*entity, F.col(position).alias("__at")).agg(*[F.sum(v).alias(f"__n_{x}") for x, v in amounts.items()]).crossJoin(F.broadcast(width))
    counted = counted.withColumn("__block", F.floor(F.col("__at") / F.col("__width")).cast("long")).drop("__width")
    blocks = counted.groupBy(*entity, "__block").agg(*[F.sum(f"__n_{x}").alias(f"__m_{x}") for x in amounts])
    every, inside = W.partitionBy(*entity), W.partitionBy(*entity, "__block").orderBy("__at").rowsBetween(W.unboundedPreceding, 0)
    earlier = every.orderBy("__block").rowsBetween(W.unboundedPreceding, -1)
    before = blocks.select(
        *entity, "__block", *[F.sum(f"__m_{x}").over(every).alias(f"{x}_whole") for x in amounts],
        *[F.coalesce(F.sum(f"__m_{x}").over(earlier), F.lit(0)).alias(f"__b_{x}") for x in amounts],
    )
    summed = counted.select("*", *[F.sum(f"__n_{x}").over(inside).alias(f"__s_{x}") for x in amounts]).join(before, [*entity, "__block"])
    upto = {x: F.col(f"__b_{x}") + F.col(f"__s_{x}") for x in amounts}
    sums = [c for x in amounts for c in ((upto[x] - F.col(f"__n_{x}")).alias(f"{x}_before"), upto[x].alias(f"{x}_upto"), F.col(f"{x}_whole"))]
    return summed.select(*entity, F.col("__at").alias(position), *sums)


def _met(df: DataFrame, entity: list[str], start: str, end: str, value: str | None = None) -> DataFrame:
    """entity, rank, whole, gap_start, gap_end: the end of each rank and the start of the next, where positions change there.

    value: also `low`, what the intervals that begin before gap_end add up to,
    and `all`, what those of the entity do.
    """
    rows = usable_intervals(df, entity, start, end)
    amount = F.coalesce(F.col(value), F.lit(0)) if value else F.lit(0)
    begins = F.struct(F.lit(0).alias("__kind"), F.col(start).alias("__place"), amount.alias("__amount"))
    ends = F.struct(F.lit(1).alias("__kind"), F.col(end).alias("__place"), (amount * 0).alias("__amount"))
    points = rows.select(*entity, F.explode(F.array(begins, ends)).alias("x")).select(*entity, "x.__kind", "x.__place", "x.__amount")
    amounts = {"n": F.lit(1).cast("long")} | ({"v": F.col("__amount")} if value else {})
    ranked = _running(points, [*entity, "__kind"], "__place", amounts, block_width(rows, start, end))
    is_end = F.col("__kind") == 1
    more = [F.max(F.when(~is_end, F.col("v_before"))).alias("low"), F.max(F.when(~is_end, F.col("v_whole"))).alias("all")] if value else []
    return ranked.groupBy(*entity, F.when(is_end, F.col("n_upto")).otherwise(F.col("n_before")).alias("rank")).agg(
        F.max("n_whole").alias("whole"), F.max(F.when(is_end, F.col("__place"))).alias("gap_start"), F.max(F.when(~is_end, F.col("__place"))).alias("gap_end"), *more
    )


def gaps(df: DataFrame, entity: list[str], start: str, end: str) -> DataFrame:
    """entity, gap_start, gap_end: the gaps between neighbouring stretches of each entity.

    Half-open intervals that overlap or touch are one stretch; there is no gap
    before the first or after the last.  Rows with a null entity, start or end,
    and empty or reversed intervals, are none; repeated ones change nothing.
    """
    return _met(df, entity, start, end).where("gap_end > gap_start").select(*entity, "gap_start", "gap_end")


def _paired_bounds(df: DataFrame, entity: list[str], start: str, end: str, value: str | None = None) -> DataFrame:
    """entity, stretch_start, stretch_end and, with a value, low, high, all.

    A bound is a gap or lies before the first or behind the last rank; bounds,
    used twice, are written to the checkpoint folder.  Each opens the stretch
    of its place and closes the one before.
    """
    sums = ["low", "all"] if value else []
    bounds = _met(df, entity, start, end, value).where("gap_end > gap_start or rank = 0 or rank = whole")
    bounds = cut(bounds.select(*entity, "rank", "gap_start", "gap_end", *sums))
    ranks = block_width(bounds, "rank", "rank")
    placed = _running(bounds, entity, "rank", {"n": F.lit(1).cast("long")}, ranks).select(*entity, "rank", F.col("n_upto").alias("place"))
    none = {c: F.lit(None).cast(bounds.schema[c].dataType) for c in ("gap_end", *sums)}
    opening = [F.col("gap_end").alias("opens"), none["gap_end"].alias("closes")]
    closing = [none["gap_end"].alias("opens"), F.col("gap_start").alias("closes")]
    if value:
        opening += [F.col("low").alias("low"), none["low"].alias("high"), F.col("all").alias("all")]
        closing += [none["low"].alias("low"), F.col("low").alias("high"), none["all"].alias("all")]
    sides = F.array(F.struct(F.col("place").alias("place"), *opening), F.struct((F.col("place") - 1).alias("place"), *closing))
    parts = bounds.join(placed, [*entity, "rank"]).select(*entity, F.explode(sides).alias("x")).where("coalesce(x.opens, x.closes) is not null")
    return parts.groupBy(*entity, F.col("x.place").alias("place")).agg(
        F.max("x.opens").alias("stretch_start"), F.max("x.closes").alias("stretch_end"), *[F.max(f"x.{c}").alias(c) for c in ("low", "high", "all") if value]
    ).drop("place")


def stretches(df: DataFrame, entity: list[str], start: str, end: str) -> DataFrame:
    """entity, stretch_start, stretch_end: the continuous covered stretches of each entity.

    Boundaries are the gaps' ends and the outermost positions; the i-th opening
    boundary is paired with the i-th closing one, by places built like the ranks.
    """
    return _paired_bounds(df, entity, start, end)


def stretch_sums(df: DataFrame, entity: list[str], start: str, end: str, value: str) -> DataFrame:
    """entity, stretch_start, stretch_end, value: the stretches, with the values of their intervals summed.

    Gives what operators.intervals.merge_sum gives for intervals that are not
    empty, for keys that may hold a large share of all rows.  Running sums of
    the values are built with the ranks; a stretch holds what was added between
    its start and the next one's.  Null values count as none.
    """
    bounds = _paired_bounds(df, entity, start, end, value)
    return bounds.select(*entity, "stretch_start", "stretch_end", (F.coalesce("high", "all") - F.col("low")).alias(value))
