"""Composition of sequences, and correction of depth for its bias."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from spanforge.functions.loess import loess_fit
from spanforge.functions.rounding import round_r

# Window of the fit, least coverage and bins for it, and the names of conserved domains.
LEAST_GC, GC_END, LEAST_COVERAGE, LEAST_BINS, CONSERVED = 0.2, 0.73, 0.05, 8, "baseline|uc"


class EmptyJoin(ValueError):
    """Depth and composition have no name in common."""


def sequence_counts(df: DataFrame, name: str = "name", seq: str = "seq", excluded: str = "ATN", known: str = "CGcgatn") -> DataFrame:
    """name, length, gc, soft_masked, ambiguous of each name, in bytes; rows of one name add up.

    gc counts what is not excluded, case mattering; soft_masked the lower-case
    letters among it; ambiguous what is neither excluded nor known.  Null
    sequences count as empty.
    """
    s = F.coalesce(F.col(seq), F.lit(""))
    counts = {
        "length": F.octet_length(s),
        "gc": F.octet_length(F.translate(s, excluded, "")),
        "soft_masked": F.octet_length(s) - F.octet_length(F.regexp_replace(s, "[a-z]", "")),
        "ambiguous": F.octet_length(F.translate(s, excluded + known, "")),
    }
    return df.groupBy(F.col(name).alias("name")).agg(*[F.sum(c.cast("long")).alias(n) for n, c in counts.items()])


def gc_fraction(gc: Column, length: Column) -> Column:
    """Share of gc; NaN for an empty sequence."""
    return F.coalesce(F.try_divide(gc.cast("double"), length.cast("double")), F.lit(float("nan")))


def contig_chunks(contigs: DataFrame, size: int = 1 << 16, contig: str = "contig", seq: str = "seq") -> DataFrame:
    """contig, chunk, piece: sequences cut into pieces of `size` positions."""
    last = F.expr(f"(length(`{seq}`) - 1) div {size}")
    cut = contigs.where(F.length(seq) > 0).withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    return cut.select(F.col(contig).alias("contig"), "chunk", F.substring(F.col(seq), (F.col("chunk") * size + 1).cast("int"), F.lit(size)).alias("piece"))


def region_pieces(regions: DataFrame, chunks: DataFrame, size: int = 1 << 16) -> DataFrame:
    """name, chrom, start, end, chunk, part of each region; a region past its contig's end gets what there is."""
    wide = regions.where(F.col("start") < F.col("end")).withColumn("chunk", F.explode(F.expr(f"sequence(start div {size}, (end - 1) div {size})")))
    met = wide.join(chunks, (F.col("chrom") == F.col("contig")) & (wide["chunk"] == chunks["chunk"]))
    low = F.greatest(F.col("start"), wide["chunk"] * size)
    high = F.least(F.col("end"), (wide["chunk"] + 1) * size)
    part = F.substring(F.col("piece"), (low - wide["chunk"] * size + 1).cast("int"), (high - low).cast("int"))
    return met.select("name", "chrom", "start", "end", wide["chunk"].alias("chunk"), part.alias("part"))


def region_gc(regions: DataFrame, chunks: DataFrame, size: int = 1 << 16, excluded: str = "ATN") -> DataFrame:
    """name, length, gc, soft_masked, ambiguous of each region: counts add up over pieces, so no sequence is put together."""
    return sequence_counts(region_pieces(regions, chunks, size), "name", "part", excluded)


def region_sequences(regions: DataFrame, chunks: DataFrame, size: int = 1 << 16) -> DataFrame:
    """name, chrom, start, end, seq of each region, not complemented; a group is one region's pieces."""
    pieces = region_pieces(regions, chunks, size)
    parts = F.sort_array(F.collect_list(F.struct("chunk", "part")))
    return pieces.groupBy("name", "chrom", "start", "end").agg(F.array_join(F.transform(parts, lambda p: p.part), "").alias("seq"))


def latest_by_name(df: DataFrame, name: str, value: str, ord: str) -> DataFrame:
    """The last value of each name."""
    return df.groupBy(name).agg(F.max_by(value, ord).alias(value))


def conserved(domain: Column, anchored: bool) -> Column:
    """Names that begin with, or (not anchored) contain, the mark of a conserved domain."""
    return domain.rlike(f"^({CONSERVED})" if anchored else CONSERVED)


def fit_bins(df: DataFrame, by: list[str]) -> DataFrame:
    """by, percent_gc, mean_log, n: mean log coverage of the conserved domains of each composition bin inside the window."""
    inside = conserved(F.col("domain"), True) & (F.col("percent_gc") >= LEAST_GC) & (F.col("percent_gc") < GC_END) & (F.col("coverage") > LEAST_COVERAGE)
    return df.where(inside).groupBy(*by, "percent_gc").agg(F.avg(F.ln("coverage")).alias("mean_log"), F.count("*").alias("n"))


def fit_factors(bins: DataFrame, by: str, strict: bool = True) -> DataFrame:
    """by, bin (percent), factor, first, last: overall mean of the bins over their smoothed value.

    One group is a sample's bins, at most 53 of them.  Fewer than eight are an
    error or, not strict, give no rows.
    """

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("percent_gc")
        x, y = table.column("percent_gc").to_numpy(), table.column("mean_log").to_numpy()
        if len(x) < LEAST_BINS and not strict:
            none = pa.array([], pa.float64())
            return pa.table({by: table.column(by).slice(0, 0), "bin": none.cast(pa.int32()), "factor": none, "first": none, "last": none})
        if len(x) < LEAST_BINS:
            raise ValueError(f"only {len(x)} composition bins hold conserved domains; {LEAST_BINS} are needed to fit a curve")
        factor = y.mean() / loess_fit(x, y)
        return pa.table(
            {by: table.column(by), "bin": pa.array((x * 100).round().astype("int32")), "factor": pa.array(factor)}
            | {"first": pa.array([factor[0]] * len(x)), "last": pa.array([factor[-1]] * len(x))}
        )

    kind = dict(bins.dtypes)[by]
    return bins.groupBy(by).applyInArrow(run, f"`{by}` {kind}, bin int, factor double, first double, last double")


def factor_for(percent_gc: Column) -> Column:
    """Factor of a row joined with its bin and the ends of its model: flat outside the window, 1 for a bin not fitted."""
    return (
        F.when(percent_gc < LEAST_GC, F.col("first")).when(percent_gc >= GC_END, F.col("last")).otherwise(F.coalesce("factor", F.lit(1.0)))
    )


def powered(coverage: Column, k: Column) -> Column:
    """exp(k ln(coverage)), with what that gives in floating point where the coverage is 0 or negative; null without a k."""
    zero = F.when(k > 0, F.lit(0.0)).when(k < 0, F.lit(float("inf"))).otherwise(F.lit(float("nan")))
    return F.when(k.isNull(), F.lit(None).cast("double")).when(coverage == 0, zero).when(coverage < 0, F.lit(float("nan"))).otherwise(F.exp(F.ln(coverage) * k))


def corrected_depth(depth: DataFrame, gc: DataFrame, by: str = "sample", check: bool = False, strict: bool = True, keep: list[str] = ()) -> DataFrame:
    """by, domain, coverage, percent_gc, k_gc, corrected_coverage: depth corrected for composition and scaled to copies.

    depth: by, domain, coverage; gc: domain, percent_gc (one row for each; see
    latest_by_name).  All samples are corrected in one job, each with its own
    curve and its own unit, half the median of its conserved domains.  Names
    missing on either side are left out.  check: fail if none is left.  keep:
    further columns of depth to carry along.

    A sample with too few bins for a curve is an error.  Not strict: it keeps
    its rows, with null k_gc and corrected_coverage, and a last column `reason`
    names what a sample lacks (`bins`; `unit` without any conserved domain to
    scale by; else null), so that no sample takes the results of others along.
    """
    joined = depth.select(by, *keep, "domain", "coverage").join(gc.select("domain", round_r(F.col("percent_gc"), 2).alias("percent_gc")), "domain")
    if check and joined.isEmpty():
        raise EmptyJoin("depth and composition have no name in common; do the names of one carry a ::chrom:start-end suffix?")
    factors = fit_factors(fit_bins(joined, [by]), by, strict)
    ends = factors.select(by, "first", "last").distinct()
    keyed = joined.withColumn("bin", F.round(F.col("percent_gc") * 100).cast("int"))
    rows = keyed.join(factors.select(by, "bin", "factor"), [by, "bin"], "left").join(ends, by, "inner" if strict else "left")
    rows = rows.withColumn("k_gc", F.when(F.col("first").isNotNull(), factor_for(F.col("percent_gc"))))
    rows = rows.withColumn("__corrected", powered(F.col("coverage"), F.col("k_gc")))
    unit = haploid_unit(rows.select(by, "domain", F.col("__corrected").alias("corrected_coverage")), by)
    rows = rows.join(unit, by, "inner" if strict else "left").select(
        by, *keep, "domain", "coverage", "percent_gc", "k_gc", F.try_divide(F.col("__corrected"), F.col("unit")).alias("corrected_coverage"),
        F.when(F.col("first").isNull(), "bins").when(F.col("unit").isNull(), "unit").alias("reason"),
    )
    return rows.drop("reason") if strict else rows


#: Classes of values over the middle 98 % of all, for medians.
CLASSES = 4096


def exact_medians(df: DataFrame, by: str, value: str) -> DataFrame:
    """by, median: the middle value of each group, or the mean of the two middle ones; NaN counts as greatest, null not at all.

    Values are counted in classes of equal width, whose running counts tell in
    which one the middle lies; only that class's values are put in order.  So no
    task holds a group, however large.
    """
    rows = df.where(F.col(value).isNotNull() & F.col(by).isNotNull()).select(by, F.col(value).cast("double").alias("__v"))
    finite = F.when(F.abs("__v") < float("inf"), F.col("__v"))
    ends = rows.agg(F.percentile_approx(finite, [0.01, 0.99], 1000).alias("e")).select(F.col("e")[0].alias("__low"), ((F.col("e")[1] - F.col("e")[0]) / CLASSES).alias("__width"))
    step = F.when(F.col("__width") > 0, F.col("__width")).otherwise(F.lit(1.0))
    most = float(1 << 20)
    place = F.greatest(F.least((F.col("__v") - F.coalesce("__low", F.lit(0.0))) / step, F.lit(most)), F.lit(-most))  # NaN is greatest
    classed = rows.crossJoin(F.broadcast(ends)).select(by, "__v", F.when(F.isnan("__v"), F.lit(most)).otherwise(F.floor(place)).cast("long").alias("__class"))
    whole = W.partitionBy(by)
    counts = classed.groupBy(by, "__class").agg(F.count("*").alias("__n")).select(
        by, "__class", (F.sum("__n").over(whole.orderBy("__class").rowsBetween(W.unboundedPreceding, 0)) - F.col("__n")).alias("__before"), "__n",
        F.expr(f"(sum(__n) over (partition by `{by}`) + 1) div 2").alias("__first"), F.expr(f"sum(__n) over (partition by `{by}`) div 2 + 1").alias("__second"),
    )
    middle = counts.where("(__first > __before and __first <= __before + __n) or (__second > __before and __second <= __before + __n)").drop("__n")
    inside = classed.join(middle, [by, "__class"])
    rank = F.col("__before") + F.row_number().over(W.partitionBy(by, "__class").orderBy("__v"))
    ranked = inside.withColumn("__rank", rank).where("__rank = __first or __rank = __second")
    return ranked.groupBy(by).agg(F.avg("__v").alias("median"))


def haploid_unit(df: DataFrame, by: str) -> DataFrame:
    """by, unit: half the exact median of the conserved domains, wherever their name has the mark."""
    return exact_medians(df.where(conserved(F.col("domain"), False)), by, "corrected_coverage").select(by, (F.col("median") / 2).alias("unit"))
