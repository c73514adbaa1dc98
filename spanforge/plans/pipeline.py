"""Whole chains: alignments to depth, depth to copies, for all samples at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from spanforge.checkpoints import cut, small_side
from spanforge.operators import fragments as fr
from spanforge.operators import intervals as iv
from spanforge.operators.gc import corrected_depth
from spanforge.operators.pairing import mate_pairs, single_intervals

#: Most rows that one task gives, on average, where each of its rows is repeated many times.
TASK_ROWS = 4_000_000


def fragment_intervals(alignments: DataFrame, paired: bool = True, check: bool = False, draw: bool = True, by: list[str] = ()) -> DataFrame:
    """by and BED6 of what each read or pair covers. check: fail at once where no pair is proper.

    by: the columns of a sample.  Each sample has its own pairs and its own
    distribution of their distances; one without a proper pair has no rows.
    """
    if not paired:
        return single_intervals(alignments, by)
    pairs = mate_pairs(alignments, by=by)
    stats = fr.fragment_stats(pairs, by=by)
    return fr.fragments(pairs, fr.require_pairs(stats) if check else stats, draw, by)


def domain_depth(domains: DataFrame, covering: DataFrame, width: int | None = None) -> DataFrame:
    """name, depth of each domain: its covered positions over its length plus one.

    One row for each domain, uncovered ones with 0.  The interval sort of the
    file formats is not needed for this and does not happen.
    """
    counted = covering.groupBy("chrom", "start", "end").agg(F.count("*").alias("__n"))
    met = iv.overlap_inner(domains.select("name", "chrom", "start", "end"), counted, width=width)
    place = [F.col(f"a_{c}").alias(n) for c, n in (("name", "key"), ("start", "start"), ("end", "end"))]
    sums = met.select(*place, (F.col("overlap") * F.col("b___n")).alias("value"))
    every = domains.select(F.col("name").alias("key"), "start", "end", F.lit(0).cast("long").alias("value"))
    merged = iv.merge_sum(sums.unionByName(every))
    return merged.select(F.col("key").alias("name"), iv.depth(F.col("value"), F.col("start"), F.col("end")).alias("depth"))


def coverage(alignments: DataFrame, domains: DataFrame, paired: bool = True, width: int | None = None, draw: bool = True) -> DataFrame:
    """name, depth of one sample's alignments over the domains."""
    return domain_depth(domains, fragment_intervals(alignments, paired, draw=draw), width)


def cohort_coverage(covering: DataFrame, domains: DataFrame, sample: str = "sample", width: int | None = None, samples: DataFrame | None = None) -> DataFrame:
    """sample, name, depth of every domain in every sample, for all samples in one job; 0 where a sample does not cover it.

    covering: sample, chrom, start, end of fragments.  The sample travels with
    the fragments as a number, so domains are not repeated for the join.  Zeros of a sample
    count in its unit like any other depth.  samples: those that have to come
    out even if they cover nothing anywhere.  Fragments of no sample are left
    out.
    """
    counted = covering.where(F.col(sample).isNotNull()).groupBy(sample, "chrom", "start", "end").agg(F.count("*").alias("__n"))
    counted = cut(counted)
    names = counted.select(sample) if samples is None else counted.select(sample).unionByName(samples.select(sample))
    numbers = _numbered(names, sample)
    placed = counted.join(numbers, sample).select("__no", "chrom", "start", "end", "__n")
    met = iv.overlap_inner(domains.select("name", "chrom", "start", "end"), placed, width=width)
    place = ["name", "start", "end"]
    covered = met.groupBy(*[F.col(f"a_{c}").alias(c) for c in place], F.col("b___no").alias("__no")).agg(F.sum(F.col("overlap") * F.col("b___n")).alias("value"))
    every = _for_every_number(domains.select(*place), covered, place, numbers.count())
    return every.join(numbers, "__no").select(sample, "name", iv.depth(F.col("value"), F.col("start"), F.col("end")).alias("depth"))


def _numbered(names: DataFrame, sample: str) -> DataFrame:
    """sample, __no: the different samples and their numbers from 1, a list of names sorted in one task; to be joined by number or name."""
    names = names.where(F.col(sample).isNotNull()).distinct()
    return small_side(names.withColumn("__no", F.row_number().over(W.orderBy(sample))))


def _for_every_number(df: DataFrame, covered: DataFrame, place: list[str], count: int) -> DataFrame:
    """place, __no, value: each different place of df once for each number from 1 to count, with the value that `covered` has for both, else 0.

    covered: place, __no, value, a row for each pair that has one.  A place
    holds the list of its own in one row and is repeated only after the last
    shuffle, so no pair without a value is ever moved.  Tasks are as many as
    the rows that come out ask for, not as the few that go in.
    """
    tasks = max(-(-df.count() * count // TASK_ROWS), df.sparkSession.sparkContext.defaultParallelism)
    none = [F.lit(None).cast(t).alias(c) for c, t in covered.select("__no", "value").dtypes]
    both = covered.unionByName(df.select(*place, *none)).repartition(tasks, *place)
    lists = both.groupBy(*place).agg(F.collect_list(F.when(F.col("__no").isNotNull(), F.struct("__no", "value"))).alias("__own"))
    own, numbers = F.col("__own.__no"), F.sequence(F.lit(1), F.lit(count)) if count else F.array().cast("array<int>")
    others = F.when(F.size(own) == 0, numbers).otherwise(F.array_except(numbers, own))
    repeated = lists.select(*place, F.col("__own.value").alias("__values"), F.posexplode(F.concat(own, others)).alias("__pos", "__no"))
    return repeated.select(*place, "__no", F.coalesce(F.get("__values", "__pos"), F.lit(0).cast("long")).alias("value"))


def cohort_depth(alignments: DataFrame, domains: DataFrame, sample: str = "sample", paired: bool = True, width: int | None = None, draw: bool = True) -> DataFrame:
    """sample, name, depth: the whole chain from the alignments of all samples in one job.

    A sample without a proper pair has no rows, and no other sample suffers
    from it: see cohort_status.
    """
    covering = fragment_intervals(alignments, paired, draw=draw, by=[sample])
    return cohort_coverage(covering, domains, sample, width)


def cohort_status(samples: DataFrame, depths: DataFrame, copies: DataFrame, sample: str = "sample") -> DataFrame:
    """sample, status, domains: how each sample fared, one row for each of samples.

    status: `coverage` if it has no depth at all (no proper pair, or nothing
    aligned), `names` if none of its domains is in the composition table,
    `bins` or `unit` if it could not be corrected (see copy_numbers), else
    `done`.  domains: how many of its domains have a corrected depth.
    """
    have = depths.select(sample).distinct().withColumn("__depth", F.lit(True))
    ends = copies.groupBy(sample).agg(F.max("reason").alias("__reason"), F.count(F.when(F.col("reason").isNull(), 1)).alias("domains"), F.lit(True).alias("__copies"))
    joined = samples.select(sample).distinct().join(have, sample, "left").join(ends, sample, "left")
    status = F.when(F.col("__depth").isNull(), "coverage").when(F.col("__copies").isNull(), "names").otherwise(F.coalesce("__reason", F.lit("done")))
    return joined.select(sample, status.alias("status"), F.coalesce("domains", F.lit(0)).alias("domains"))


def copy_numbers(depths: DataFrame, gc: DataFrame, sample: str = "sample") -> DataFrame:
    """Corrected depth, in copies, of every sample, or the reason why a sample has none: see operators.gc.corrected_depth."""
    return corrected_depth(depths.select(sample, F.col("name").alias("domain"), F.col("depth").alias("coverage")), gc, sample, strict=False)
