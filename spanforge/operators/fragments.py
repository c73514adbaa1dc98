"""From pairs of mates to fragments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanforge.checkpoints import small_side
from spanforge.functions.rounding import round_half_even
from spanforge.functions.seeded import half_draw

# Distance up to which a pair counts in the first pass; distances after which it stops; deviations allowed in the second.
FIRST_CEILING, MOST_DISTANCES, DEVIATIONS = 800, 50_000_002, 5

BEDPE = ["chrom1", "start1", "end1", "chrom2", "start2", "end2", "name", "score", "strand1", "strand2"]


class NoProperPairs(ValueError):
    """No pair is proper, so there is no distribution of distances."""


def inner_distance() -> Column:
    return F.col("start2") - F.col("end1")


def proper_pair(ceiling: Column) -> Column:
    """Mapped on one chromosome and facing each other at most `ceiling` apart, overlapping or in order."""
    inside = F.col("start1").between(F.col("start2"), F.col("end2")) | F.col("end1").between(F.col("start2"), F.col("end2"))
    return (
        (F.col("chrom1") != ".") & (F.col("chrom2") != ".") & (F.col("chrom1") == F.col("chrom2")) & (F.col("strand1") != F.col("strand2"))
        & (inner_distance() <= ceiling) & (inside | (F.col("start1") <= F.col("start2")))
    )


def fragment_stats(pairs: DataFrame, ord: str | None = None, most: int = MOST_DISTANCES, by: list[str] = ()) -> DataFrame:
    """by, mean, sd, max_inner_distance, n of the inner distances of proper pairs; one row for each value of `by`.

    Integer sums, so the result does not depend on order or partitioning: mean
    rounded half to even, population deviation about the rounded mean, rounded
    likewise.  ord: only the first `most` proper pairs in this order count, of
    all pairs; not with `by`.  Without any proper pair the row has n = 0 and
    nulls; with `by`, values without any have no row.
    """
    proper = pairs.where(proper_pair(F.lit(FIRST_CEILING)))
    if ord is not None:
        if by:
            raise ValueError("a limit in order is for one sample")
        proper = proper.orderBy(ord).limit(most)
    d = inner_distance()
    sums = proper.groupBy(*by).agg(F.count("*").alias("n"), F.sum(d).alias("s"), F.sum(d * d).alias("q"))
    mean = round_half_even(F.try_divide(F.col("s"), F.col("n")))
    sums = sums.withColumn("mean", mean)
    spread = F.try_divide(F.col("q") - 2 * F.col("mean") * F.col("s") + F.col("n") * F.col("mean") * F.col("mean"), F.col("n"))
    sums = sums.withColumn("sd", round_half_even(F.sqrt(spread)))
    return sums.select(*by, "mean", "sd", (F.col("mean") + DEVIATIONS * F.col("sd")).alias("max_inner_distance"), "n")


def require_pairs(stats: DataFrame) -> DataFrame:
    """stats, after a check that there were proper pairs."""
    if stats.first()["n"] == 0:
        raise NoProperPairs(
            "no proper pairs, hence no distribution of distances: the alignment may be against another reference, or not sorted by name"
        )
    return stats


def pair_line() -> Column:
    return F.concat_ws("\t", *[F.col(c).cast("string") for c in BEDPE])


def fragments(pairs: DataFrame, stats: DataFrame, draw: bool = True, by: list[str] = ()) -> DataFrame:
    """by and BED6 of fragments: one for a proper pair, one for each mapped end of any other.

    A lone end is extended away from it by half a draw from the distribution,
    seeded by the pair's own line; its start is never below 0.  draw=False
    extends by nothing.  stats is one row, or one for each value of `by`; pairs
    of values without a distribution are left out.
    """
    own = stats.select(*by, "mean", "sd", "max_inner_distance")
    joined = pairs.join(small_side(own), list(by)) if by else pairs.crossJoin(F.broadcast(own))
    joined = joined.withColumn("__proper", F.coalesce(proper_pair(F.col("max_inner_distance")), F.lit(False)))
    fused = joined.where("__proper").select(
        *by, F.col("chrom1").alias("chrom"), F.least("start1", "start2").alias("start"), F.greatest("end1", "end2").alias("end"),
        "name", "score", F.col("strand1").alias("strand"),
    )
    broken = joined.where("not __proper")
    extension = half_draw(pair_line(), F.col("mean"), F.col("sd")) if draw else F.lit(0).cast("long")
    broken = broken.withColumn("__by", extension)
    ends = [F.struct(*[F.col(f"{c}{i}").alias(c) for c in ("chrom", "start", "end", "strand")]) for i in (1, 2)]
    single = broken.withColumn("e", F.explode(F.filter(F.array(*ends), lambda e: e.chrom != "."))).select(
        *by, F.col("e.chrom").alias("chrom"),
        F.greatest(F.col("e.start") - F.when(F.col("e.strand") == "-", F.col("__by")).otherwise(0), F.lit(0)).alias("start"),
        (F.col("e.end") + F.when(F.col("e.strand") == "+", F.col("__by")).otherwise(0)).alias("end"),
        "name", "score", F.col("e.strand").alias("strand"),
    )
    return fused.unionByName(single)
