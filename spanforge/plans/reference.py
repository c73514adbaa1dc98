"""One query for each operator of the survey, over the whole test tables, and SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanforge.functions import names as nm
from spanforge.functions.numbers import as_awk
from spanforge.functions.rounding import round_r
from spanforge.operators import fragments as fr
from spanforge.operators import gc as gco
from spanforge.operators import intervals as iv
from spanforge.operators import logs as lg
from spanforge.operators import pairing as pr
from spanforge.operators import selection as sel
from spanforge.operators import trimming as tr
from spanforge.operators.copies import bare_name, newest
from spanforge.operators.records import parsed_records
from spanforge.operators.stretches import bare_chrom, stretch_sums
from spanforge.plans import pipeline
from spanforge.plans.problems import _P4, _newest_sql
from spanforge.plans.views import (
    ALIGNMENTS, DOMAINS, PAIRS, RANK, READS, STATS, TRIM_ROWS, alignments, domains, fragments_sql, proper_sql, reads, stats_sql, trim_rows,
)
from spanforge.sources.files import line_digest
from spanforge.tables import table

CENTRES = ["TARNLAB", "ORYX", "FJ", "GLIMMER", "KELPIE", "QUILL"]
QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


# Interval operators.

_OVERLAP = "greatest(least(d.e, r.e) - greatest(d.s, r.s), 0)"
_SUMS = f"""sums as (select d.name, d.s, d.e, cast(coalesce(sum(case when r.s is null then 0 else {_OVERLAP} end), 0) as bigint) overlap_sum
  from domains d left join reads r on d.chrom = r.chrom and d.s < r.e and r.s < d.e group by 1, 2, 3)"""


@query(f"""with {DOMAINS}, {READS} select d.name, r.name as read, r.s as read_start, case when r.s is null then 0 else {_OVERLAP} end overlap
  from domains d left join reads r on d.chrom = r.chrom and d.s < r.e and r.s < d.e""")
def interval_overlap_left(spark: SparkSession, d: str) -> DataFrame:
    met = iv.overlap_left(domains(spark, d), reads(spark, d))
    return met.select(F.col("a_name").alias("name"), F.col("b_name").alias("read"), F.col("b_start").alias("read_start"), "overlap")


@query(f"with {DOMAINS}, {READS}, {_SUMS} select name, overlap_sum from sums")
def domain_overlap_sum(spark: SparkSession, d: str) -> DataFrame:
    return iv.overlap_sums(domains(spark, d), reads(spark, d)).select("name", "overlap_sum")


@query(f"with {DOMAINS}, {READS}, {_SUMS} select name, overlap_sum / cast(e - s + 1 as double) as depth from sums")
def domain_read_depth(spark: SparkSession, d: str) -> DataFrame:
    return pipeline.domain_depth(domains(spark, d), reads(spark, d))


@query(f"with {DOMAINS}, {READS} select name from domains d where not exists (select 1 from reads r where d.chrom = r.chrom and d.s < r.e and r.s < d.e)")
def uncovered_domains(spark: SparkSession, d: str) -> DataFrame:
    met = iv.overlap_left(domains(spark, d), reads(spark, d))
    return met.where("b_name is null").select(F.col("a_name").alias("name"))


_MERGED = f"""with {READS}, m as (select *, max(e) over (partition by chrom order by s, e rows between unbounded preceding and 1 preceding) w from reads),
  o as (select *, sum(case when s <= w then 0 else 1 end) over (partition by chrom order by s, e rows unbounded preceding) k from m)
  select chrom, min(s) as first, max(e) as last, cast(sum(score) as bigint) as total from o group by chrom, k"""


def _scored(spark: SparkSession, d: str) -> DataFrame:
    return reads(spark, d).select("chrom", F.col("start").alias("first"), F.col("end").alias("last"), F.col("score").cast("long").alias("total"))


@query(_MERGED)
def merge_book_ended(spark: SparkSession, d: str) -> DataFrame:
    return iv.merge_sum(_scored(spark, d), "chrom", "first", "last", "total")


@query(_MERGED)
def merge_by_stretches(spark: SparkSession, d: str) -> DataFrame:
    """The same merge for keys that hold a large share of all rows."""
    merged = stretch_sums(_scored(spark, d), ["chrom"], "first", "last", "total")
    return merged.withColumnsRenamed({"stretch_start": "first", "stretch_end": "last"})


@query(f"""with {READS} select chrom, s as first, e as last, name from reads
  order by chrom, s, chrom || chr(9) || s || chr(9) || e || chr(9) || name || chr(9) || score || chr(9) || strand limit 100""")
def interval_total_order_topk(spark: SparkSession, d: str) -> DataFrame:
    """A report of the first hundred intervals in total order."""
    rows = iv.in_total_order(reads(spark, d), line=iv.bed_line("chrom", "start", "end", "name", "score", "strand")).limit(100)
    return rows.select("chrom", F.col("start").alias("first"), F.col("end").alias("last"), "name")


@query(f"""with {READS} select chrom, s as first, e as last, name, row_number() over (order by chrom, s, chrom || chr(9) || s || chr(9) || e || chr(9) || name || chr(9) || score || chr(9) || strand) as place from reads""")
def interval_total_order(spark: SparkSession, d: str) -> DataFrame:
    """Every interval with its place in total order."""
    rows = iv.placed_in_total_order(reads(spark, d), line=iv.bed_line("chrom", "start", "end", "name", "score", "strand"))
    return rows.select("chrom", F.col("start").alias("first"), F.col("end").alias("last"), "name", "place")


@query(f"""with {DOMAINS}, i as (select sample_name, 'chr' || regexp_replace(trim(chrom, ' '), '^(?i:chr)', '') chrom, chrom_start s, chrom_end e
  from read_interval where chrom_start < chrom_end),
  x as (select sample_name, d.name, d.s, d.e, sum(least(d.e, i.e) - greatest(d.s, i.s)) o from domains d join i on d.chrom = i.chrom and d.s < i.e and i.s < d.e group by all),
  n as (select distinct sample_name from read_interval where sample_name is not null)
  select n.sample_name, d.name, coalesce(o, 0) / cast(d.e - d.s + 1 as double) as depth from n cross join domains d left join x on x.sample_name = n.sample_name and x.name = d.name""")
def cohort_depth(spark: SparkSession, d: str) -> DataFrame:
    """Depth of every domain in every sample of a cohort, 0 where a sample does not cover it."""
    rows = table(spark, d, "read_interval").select(
        "sample_name", bare_chrom(F.col("chrom")).alias("chrom"), F.col("chrom_start").alias("start"), F.col("chrom_end").alias("end")
    )
    return pipeline.cohort_coverage(rows, domains(spark, d), "sample_name")


# Names, flags and pairs.


@query("""with x as (select c_name nm from customer union all select s_name from supplier)
  select nm as name, regexp_extract(nm, '^([^0-9]+)', 1) || '0' || lpad(cast(length(ltrim(regexp_extract(nm, '([0-9]+)', 1), '0')) as varchar), 6, '0')
    || ltrim(regexp_extract(nm, '([0-9]+)', 1), '0') as sort_key from x""")
def natural_names(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").select(F.col("c_name").alias("name")).unionAll(table(spark, d, "supplier").select("s_name"))
    return rows.withColumn("sort_key", nm.natural_key(F.col("name")))


@query(f"with {ALIGNMENTS} select flags, {RANK} as rank, count(*) n from alignments group by 1, 2")
def pair_rank_flags(spark: SparkSession, d: str) -> DataFrame:
    return alignments(spark, d).groupBy("flags", nm.pair_rank(F.col("flags")).alias("rank")).agg(F.count("*").alias("n"))


@query(f"""with {ALIGNMENTS} select chrom, s as first, e as last, name || case when flags & 64 <> 0 then '/1' else '' end || case when flags & 128 <> 0 then '/2' else '' end as name,
  mapq score, case when flags & 16 = 0 then '+' else '-' end strand from alignments where flags & 4 = 0""")
def single_end_intervals(spark: SparkSession, d: str) -> DataFrame:
    return pr.single_intervals(alignments(spark, d)).withColumnsRenamed({"start": "first", "end": "last"})


@query(f"with {PAIRS} select * from pairs")
def mate_pairing(spark: SparkSession, d: str) -> DataFrame:
    return pr.mate_pairs(alignments(spark, d))


@query(f"""with {PAIRS}, l as (select n.k, n.flags from n join (select k, max(rn) rn from n group by k) x using (k, rn) join sizes using (k) where odd)
  select count(*) orphans from l where flags & 1 = 1 and k < (select max(k) from n)""")
def mate_orphans(spark: SparkSession, d: str) -> DataFrame:
    return pr.mate_orphans(alignments(spark, d))


@query(f"with {PAIRS} select chrom1, count(*) n, cast(sum(start2 - end1) as bigint) inner_sum from pairs where {proper_sql('800')} group by 1")
def proper_pairs(spark: SparkSession, d: str) -> DataFrame:
    rows = pr.mate_pairs(alignments(spark, d)).where(fr.proper_pair(F.lit(fr.FIRST_CEILING)))
    return rows.groupBy("chrom1").agg(F.count("*").alias("n"), F.sum(fr.inner_distance()).alias("inner_sum"))


@query(f"with {STATS} select mean, sd, mean + 5 * sd as max_inner_distance, n from stats")
def fragment_stats(spark: SparkSession, d: str) -> DataFrame:
    return fr.fragment_stats(pr.mate_pairs(alignments(spark, d)))


@query(f"with {fragments_sql()} select chrom, s as first, e as last, name, score, strand from fragments")
def fragment_emit_noext(spark: SparkSession, d: str) -> DataFrame:
    pairs = pr.mate_pairs(alignments(spark, d))
    return fr.fragments(pairs, fr.fragment_stats(pairs), draw=False).withColumnsRenamed({"start": "first", "end": "last"})


@query()
def fragment_extension(spark: SparkSession, d: str) -> DataFrame:
    pairs = pr.mate_pairs(alignments(spark, d))
    return fr.fragments(pairs, fr.fragment_stats(pairs)).withColumnsRenamed({"start": "first", "end": "last"})


@query()
def paired_coverage(spark: SparkSession, d: str) -> DataFrame:
    """The whole chain from alignments to depth."""
    return pipeline.coverage(alignments(spark, d), domains(spark, d))


@query(f"""with {fragments_sql()}, {DOMAINS}, {_SUMS.replace('reads r', 'fragments r')}
  select name, overlap_sum / cast(e - s + 1 as double) as depth from sums""")
def paired_coverage_noext(spark: SparkSession, d: str) -> DataFrame:
    """The whole chain with lone ends as they are, which SQL can follow."""
    return pipeline.coverage(alignments(spark, d), domains(spark, d), draw=False)


@query(f"with {stats_sql('smp, ')} select smp as sample, mean, sd, mean + 5 * sd as max_inner_distance, n from stats")
def cohort_fragment_stats(spark: SparkSession, d: str) -> DataFrame:
    """The distribution of each sample's distances; samples share names, and one holds most rows."""
    return fr.fragment_stats(pr.mate_pairs(alignments(spark, d), by=["sample"]), by=["sample"])


@query(f"""with {fragments_sql('smp, ')}, {DOMAINS}, had as (select distinct smp from fragments),
  o as (select smp, name, sum(least(d.e, f.e) - greatest(d.s, f.s)) o from (select smp, chrom, s, e from fragments) f join domains d on d.chrom = f.chrom and d.s < f.e and f.s < d.e group by 1, 2)
  select had.smp as sample, d.name, coalesce(o, 0) / cast(d.e - d.s + 1 as double) as depth from had cross join domains d left join o on o.smp = had.smp and o.name = d.name""")
def cohort_paired_depth(spark: SparkSession, d: str) -> DataFrame:
    """The whole chain for all samples in one job, lone ends as they are; domains that a sample does not cover have depth 0."""
    return pipeline.cohort_depth(alignments(spark, d), domains(spark, d), draw=False)


@query(f"""with {ALIGNMENTS}, {DOMAINS}, r as (select chrom, s, e from alignments where flags & 4 = 0), {_SUMS.replace('reads r', 'r')}
  select name, overlap_sum / cast(e - s + 1 as double) as depth from sums""")
def single_end_coverage(spark: SparkSession, d: str) -> DataFrame:
    """The chain for unpaired reads."""
    return pipeline.coverage(alignments(spark, d), domains(spark, d), paired=False)


# Composition and correction.

_S = "coalesce(text, '')"


@query(f"""select 'd' || doc_id as name, cast(strlen({_S}) as bigint) length, cast(strlen(translate({_S}, 'ATN', '')) as bigint) gc,
  cast(strlen({_S}) - strlen(regexp_replace({_S}, '[a-z]', '', 'g')) as bigint) soft_masked,
  cast(strlen(translate({_S}, 'ATNCGcgatn', '')) as bigint) ambiguous from documents""")
def gc_breakdown(spark: SparkSession, d: str) -> DataFrame:
    return gco.sequence_counts(table(spark, d, "documents").select(F.expr("concat('d', doc_id) name"), F.col("text").alias("seq")))


# Each text is tiled from its first to its last character.
_REGIONS = "select doc_id, k, k * 150 as s, k * 150 + 150 as e, text from documents, unnest(range((length(text) + 149) // 150)) u(k) where text <> ''"


@query(f"""with r as ({_REGIONS}), x as (select 'd' || doc_id || '-' || k as name, substring(text, s + 1, e - s) p from r)
  select name, cast(strlen(p) as bigint) length, cast(strlen(translate(p, 'ATN', '')) as bigint) gc from x""")
def region_substring_gc(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").where("text <> ''")
    chunks = gco.contig_chunks(docs.select(F.expr("concat('d', doc_id) contig"), F.col("text").alias("seq")), 4096)
    regions = docs.select("doc_id", F.explode(F.expr("sequence(0L, (length(text) - 1L) div 150)")).alias("k")).selectExpr(
        "concat('d', doc_id, '-', k) name", "concat('d', doc_id) chrom", "k * 150 start", "k * 150 + 150 end"
    )
    return gco.region_gc(regions, chunks, 4096).select("name", "length", "gc")


_R2 = "case when ceil(x * 100) / 100 - x < x - floor(x * 100) / 100 or (ceil(x * 100) / 100 - x = x - floor(x * 100) / 100 and floor(x * 100) % 2 = 1) then ceil(x * 100) / 100 else floor(x * 100) / 100 end"
_FINITE = "from corrected where {c} is not null and not isnan({c}) and not isinf({c})"


@query(f"with p as (select percent_gc x {_FINITE.format(c='percent_gc')} and percent_gc >= 0) select {_R2} as percent_gc, count(*) n from p group by 1")
def gc_round2(spark: SparkSession, d: str) -> DataFrame:
    x = F.col("percent_gc")
    rows = table(spark, d, "corrected").where(x.isNotNull() & ~F.isnan(x) & (x < float("inf")) & (x >= 0))
    return rows.groupBy(round_r(x, 2).alias("percent_gc")).agg(F.count("*").alias("n"))


@query(f"""with p as (select percent_gc x, coverage {_FINITE.format(c='percent_gc')} and regexp_matches(trim(split_part(domain, '::', 1), ' '), '^(baseline|uc)')
    and coverage > 0.05 and not isnan(coverage) and not isinf(coverage)), b as (select {_R2} as percent_gc, coverage from p)
  select percent_gc, round(avg(ln(coverage)), 9) mean_log, count(*) n from b where percent_gc >= 0.2 and percent_gc < 0.73 group by 1""")
def gc_bin_mean_log(spark: SparkSession, d: str) -> DataFrame:
    rows = _composed(spark, d).withColumn("percent_gc", round_r(F.col("percent_gc"), 2))
    return gco.fit_bins(rows, []).select("percent_gc", F.round("mean_log", 9).alias("mean_log"), "n")


@query(f"""with p as (select percent_gc x, coverage, trim(split_part(domain, '::', 1), ' ') dom {_FINITE.format(c='percent_gc')} and coverage is not null
    and not isnan(coverage) and not isinf(coverage) and trim(split_part(domain, '::', 1), ' ') <> ''), b as (select dom, coverage, {_R2} as percent_gc from p),
  m as (select percent_gc, avg(ln(coverage)) mean_log from b where regexp_matches(dom, '^(baseline|uc)') and coverage > 0.05 and percent_gc >= 0.2 and percent_gc < 0.73 group by 1),
  f as (select percent_gc, (select avg(mean_log) from m) / mean_log factor from m)
  select b.percent_gc, round(case when b.percent_gc < 0.2 then (select arg_min(factor, percent_gc) from f) when b.percent_gc >= 0.73 then (select arg_max(factor, percent_gc) from f)
    else coalesce(f.factor, 1) end, 9) factor, count(*) n from b left join f on cast(round(b.percent_gc * 100) as int) = cast(round(f.percent_gc * 100) as int) group by 1, 2""")
def gc_model_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Factors looked up by composition, flat beyond the window; the curve is left unsmoothed so that SQL can follow."""
    rows = _composed(spark, d).withColumn("percent_gc", round_r(F.col("percent_gc"), 2))
    bins = gco.fit_bins(rows, [])
    mean = bins.agg(F.avg("mean_log").alias("mean"))
    factors = bins.crossJoin(F.broadcast(mean)).select(F.round(F.col("percent_gc") * 100).cast("int").alias("bin"), (F.col("mean") / F.col("mean_log")).alias("factor"))
    ends = factors.agg(F.min_by("factor", "bin").alias("first"), F.max_by("factor", "bin").alias("last"))
    keyed = rows.withColumn("bin", F.round(F.col("percent_gc") * 100).cast("int")).join(factors, "bin", "left").crossJoin(F.broadcast(ends))
    return keyed.groupBy("percent_gc", F.round(gco.factor_for(F.col("percent_gc")), 9).alias("factor")).agg(F.count("*").alias("n"))


def _composed(spark: SparkSession, d: str) -> DataFrame:
    finite = " and ".join(f"{c} is not null and not isnan({c}) and abs({c}) < double('infinity')" for c in ("percent_gc", "coverage"))
    return table(spark, d, "corrected").where(finite).select(bare_name(F.col("domain")).alias("domain"), "coverage", "percent_gc").where("domain <> ''")


@query()
def gc_correct_copy_number(spark: SparkSession, d: str) -> DataFrame:
    """Depth of each sample, corrected by the composition that the model table gives each domain.

    Samples with too few bins for a curve keep their rows and name the reason.
    """
    return pipeline.copy_numbers(_depths(spark, d), _composition(spark, d), "sample_name")


def _composition(spark: SparkSession, d: str) -> DataFrame:
    model = table(spark, d, "gc_model").where("length > 0").select(bare_name(F.col("name")).alias("domain"), gco.gc_fraction(F.col("gc"), F.col("length")).alias("percent_gc"), "gc_id")
    return gco.latest_by_name(model.where("percent_gc is not null and not isnan(percent_gc)"), "domain", "percent_gc", "gc_id")


def _depths(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "read_depth").where("depth >= 0").select("sample_name", bare_name(F.col("name")).alias("name"), "depth")


@query(f"""with g as (select trim(split_part(name, '::', 1), ' ') dom, arg_max(gc / cast(length as double), gc_id) x from gc_model where length > 0 and gc is not null
    and name is not null group by 1), p as (select *, {_R2} as percent_gc from g where x is not null),
  d as (select r.sample_name, p.dom, r.depth, p.percent_gc from read_depth r join p on trim(split_part(r.name, '::', 1), ' ') = p.dom where r.depth >= 0),
  b as (select sample_name, count(distinct percent_gc) filter (regexp_matches(dom, '^(baseline|uc)') and depth > 0.05 and percent_gc >= 0.2 and percent_gc < 0.73) bins,
    count(*) filter (regexp_matches(dom, 'baseline|uc')) kept, count(*) n from d where sample_name is not null group by 1),
  n as (select distinct sample_name from read_depth where sample_name is not null), h as (select distinct sample_name from read_depth where sample_name is not null and depth >= 0)
  select n.sample_name, case when h.sample_name is null then 'coverage' when b.n is null then 'names' when bins < 8 then 'bins' when kept = 0 then 'unit' else 'done' end status,
    case when bins >= 8 and kept > 0 then b.n else 0 end domains from n left join h using (sample_name) left join b using (sample_name)""")
def cohort_copy_status(spark: SparkSession, d: str) -> DataFrame:
    """How the correction of each sample ended; a sample that cannot be corrected leaves the others their rows."""
    depths = _depths(spark, d)
    copies = pipeline.copy_numbers(depths, _composition(spark, d), "sample_name")
    return pipeline.cohort_status(table(spark, d, "read_depth").where("sample_name is not null"), depths, copies, "sample_name")


_DONE = SQL["cohort_copy_status"]


@query(f"select sample_name, 2.0 as middle from ({_DONE}) where status = 'done'")
def cohort_conserved_copies(spark: SparkSession, d: str) -> DataFrame:
    """The middle of the conserved domains of each corrected sample is two copies, whatever its curve."""
    copies = pipeline.copy_numbers(_depths(spark, d), _composition(spark, d), "sample_name")
    middle = gco.exact_medians(copies.where(gco.conserved(F.col("domain"), False)), "sample_name", "corrected_coverage")
    return middle.select("sample_name", F.round("median", 9).alias("middle"))


@query("""select sample_name, median(corrected_coverage) / 2 as unit from corrected where regexp_matches(domain, 'baseline|uc')
  and corrected_coverage is not null and not isnan(corrected_coverage) and not isinf(corrected_coverage) group by 1""")
def haploid_median(spark: SparkSession, d: str) -> DataFrame:
    x = F.col("corrected_coverage")
    return gco.haploid_unit(table(spark, d, "corrected").where(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), "sample_name")


@query(f"""with a as ({_newest_sql('corrected')}), b as ({_newest_sql('corrected_mirror')}),
  m as (select a.coverage x, b.coverage y, a.dom l, b.dom r from a full join b on a.sample_name = b.sample_name and a.dom = b.dom)
  select count(*) filter (l is not null and r is not null) compared, count(*) filter (l is null or r is null) alone,
    coalesce(max(case when isinf(x) or isinf(y) or isnan(x) or isnan(y) or greatest(abs(x), abs(y)) = 0 then null else abs(x - y) / greatest(abs(x), abs(y)) end), 0.0) error from m""")
def relative_error(spark: SparkSession, d: str) -> DataFrame:
    sides = []
    for name in ("corrected", "corrected_mirror"):
        rows = table(spark, d, name).select("sample_name", bare_name(F.col("domain")).alias("domain"), "coverage", "loaded_at", "row_id").where("domain <> ''")
        one = newest(rows, ["sample_name", "domain"], ["coverage"], ["loaded_at", "row_id"])
        finite = F.when(~F.isnan("coverage") & (F.abs("coverage") < float("inf")), F.col("coverage"))
        sides.append(one.withColumn("coverage", finite))
    return lg.largest_relative_error(*sides, ["sample_name", "domain"], "coverage")


# Index records, candidates and lists.

_INDEX = _P4 + """, i as (select line_id, fld[1] file, fld[10] sample, fld[6] centre, fld[15] library, fld[11] population,
  try_cast(trim(fld[24], ' ') as bigint) reads, try_cast(trim(fld[18], ' ') as bigint) ins, fld from x where reason is null)"""
_MATE = r"case when regexp_matches(file, '_1(\.filt)?\.fastq') then 1 when regexp_matches(file, '_2(\.filt)?\.fastq') then 2 end"


def _index(spark: SparkSession, d: str) -> DataFrame:
    rows = parsed_records(table(spark, d, "index_raw"), keep=["line_id"]).where("reason is null").select("line_id", "record.*")
    return rows.selectExpr(
        "line_id", "fastq_file file", "sample_name sample", "center_name centre", "library_name library", "population",
        "try_cast(trim(read_count) as bigint) reads", "try_cast(trim(insert_size) as bigint) ins",
    )


@query(_INDEX + rf"select line_id, regexp_extract(file, '([^/]*)$', 1) base, {_MATE} mate, regexp_replace(file, '^ftp://', 'https://') url from i")
def index_files(spark: SparkSession, d: str) -> DataFrame:
    f = F.col("file")
    return _index(spark, d).select("line_id", nm.basename(f).alias("base"), nm.mate_of(f).alias("mate"), nm.secure_url(f).alias("url"))


_GROUPS = _INDEX + f""", g as (select sample, centre, library, count(*) files, coalesce(sum(reads), 0) reads, coalesce(avg(ins), 'nan'::double) mean_insert,
  arg_min(population, line_id) population, min(line_id) as first from i where {_MATE} = 2 group by 1, 2, 3)"""


def _groups(spark: SparkSession, d: str) -> DataFrame:
    rows = _index(spark, d).where(nm.mate_of(F.col("file")) == 2)
    return sel.candidate_groups(rows, ["sample", "centre", "library"], "reads", "ins", "population", "line_id")


@query(_GROUPS + "select * replace (cast(reads as varchar) as reads) from g")
def candidate_groups(spark: SparkSession, d: str) -> DataFrame:
    return _groups(spark, d).withColumn("reads", F.col("reads").cast("string"))


@query(_GROUPS + """, r as (select *, case when list_position([{c}], centre) is null or list_position([{c}], centre) = 0 then null
    when list_position([{c}], centre) <= 3 then 1 else list_position([{c}], centre) end rnk from g)
  select sample, centre, library, cast(rnk as bigint) as rank, reads * mean_insert / 3.235e9 as depth from r
  qualify row_number() over (partition by sample order by rnk nulls last, reads desc, first) = 1""".format(c=", ".join(f"'{c}'" for c in CENTRES)))
def best_library(spark: SparkSession, d: str) -> DataFrame:
    rows = _groups(spark, d).withColumn("rank", sel.preference_rank(F.col("centre"), CENTRES, 3))
    best = sel.best_per_group(rows, ["sample"], [F.col("rank").asc_nulls_last(), F.col("reads").desc(), F.col("first")])
    return best.select("sample", "centre", "library", "rank", sel.coverage_estimate(F.col("reads"), F.col("mean_insert")).alias("depth"))


_POOL = """with p as (select sample_name, upper(trim(population, ' ')) population, max(files) files, max(read_total) reads, min(candidate_id) id
  from candidate where trim(coalesce(population, ''), ' ') not in ('', 'NA') group by 1, 2),
  o as (select * from p qualify row_number() over (partition by sample_name order by reads desc nulls last, id, population) = 1)"""


def _pool(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "candidate").where("trim(coalesce(population, '')) not in ('', 'NA')")
    rows = rows.groupBy("sample_name", F.expr("upper(trim(population)) population")).agg(
        F.max("files").alias("files"), F.max("read_total").alias("reads"), F.min("candidate_id").alias("id")
    )
    return sel.best_per_group(rows, ["sample_name"], [F.col("reads").desc_nulls_last(), F.col("id"), F.col("population")])


@query(_POOL + """, m as (select *, files >= 9 as w, count(*) filter (files >= 9) over (partition by population) filled from o),
  q as (select *, row_number() over (partition by population, w order by reads desc nulls last, id) rn from m)
  select sample_name, population, w as of_interest, cast(case when w then 0 else rn end as int) place from q where w or rn + filled <= 25""")
def quota_selection(spark: SparkSession, d: str) -> DataFrame:
    pool = _pool(spark, d)
    return sel.fill_quotas(pool, pool.where("files >= 9"), "sample_name", "population", [F.col("reads").desc_nulls_last(), F.col("id")], 25)


@query("""with l as (select sample_name from corrected union select sample_name from read_depth union select sample_name from read_interval),
  f as (select sample_name from corrected where corrected_coverage is null)
  select sample_name from l where sample_name is not null and sample_name not in (select sample_name from f where sample_name is not null)""")
def interest_without_failed(spark: SparkSession, d: str) -> DataFrame:
    lists = [table(spark, d, t).select("sample_name") for t in ("corrected", "read_depth", "read_interval")]
    failed = table(spark, d, "corrected").where("corrected_coverage is null")
    return sel.without(sel.union_of_lists(*lists).where("sample_name is not null"), failed, "sample_name")


@query("select row_id, count(*) n from corrected group by 1 having count(*) > 1")
def repeated_rows(spark: SparkSession, d: str) -> DataFrame:
    return sel.repeated(table(spark, d, "corrected"), "row_id")


@query(_INDEX + "select sample, sum(reads) // 2 as expected_pairs, count(*) // 2 as expected_files, nullif(sum(reads), 0) as expected from i group by 1".replace(
    "sum(reads) // 2", "cast(coalesce(sum(reads), 0) // 2 as varchar)").replace("nullif(sum(reads), 0)", "cast(nullif(sum(reads), 0) as varchar)"))
def expected_reads_half(spark: SparkSession, d: str) -> DataFrame:
    rows = _index(spark, d)
    return lg.expected_halves(rows, "sample", "reads").join(lg.expected_reads(rows, "sample", "reads"), "sample").select(
        "sample", F.col("expected_pairs").cast("string"), "expected_files", F.col("expected").cast("string")
    )


# Logs and reports.


@query(f"with {TRIM_ROWS} select file, kind, arg_max(reads, ord) reads, min(ord) as first from t group by 1, 2")
def trim_log_latest(spark: SparkSession, d: str) -> DataFrame:
    return lg.latest_entries(trim_rows(spark, d), ["file", "kind"], "reads", "ord")


_SUMMARY = f"""with {TRIM_ROWS}, l as (select sample, file, kind, arg_max(reads, ord) reads from t group by 1, 2, 3),
  s as (select sample, cast(coalesce(sum(reads) filter (kind = 'total'), 0) as bigint) total_reads,
    cast(coalesce(sum(reads) filter (kind = 'discarded'), 0) as bigint) filtered_reads, count(*) filter (kind = 'total') files from l group by 1)"""
_SHARES = "greatest(total_reads - filtered_reads, 0) remaining_reads, case when total_reads = 0 then 0.0 else filtered_reads / cast(total_reads as double) end percent_filtered"


@query(_SUMMARY + f"select *, {_SHARES} from s")
def trim_summary(spark: SparkSession, d: str) -> DataFrame:
    latest = lg.latest_entries(trim_rows(spark, d), ["file", "kind"], "reads", "ord")
    return lg.trim_summary(latest.withColumn("sample", nm.sample_of(F.col("file"))), "sample")


@query(_SUMMARY + f""", a as (select 'u' || user_id as sample, count(distinct coalesce(props, '')) aligned from events where event_type = 'view' group by 1),
  b as (select distinct 'u' || user_id as sample from events where event_type = 'purchase'), n as (select distinct sample from t)
  select n.sample, coalesce(total_reads, 0) total_reads, aligned, aligned / cast(nullif(remaining_reads, 0) as double) percent_aligned, b.sample is not null as in_bought
  from n left join (select *, {_SHARES} from s) using (sample) left join a using (sample) left join b using (sample)""")
def sample_report(spark: SparkSession, d: str) -> DataFrame:
    rows = trim_rows(spark, d).withColumn("sample", nm.sample_of(F.col("file")))
    latest = lg.latest_entries(rows, ["sample", "file", "kind"], "reads", "ord")
    events = table(spark, d, "events").withColumn("sample", F.expr("concat('u', user_id)"))
    viewed = events.where("event_type = 'view'").groupBy("sample").agg(F.countDistinct(F.coalesce("props", F.lit(""))).alias("aligned"))
    out = lg.sample_report(rows.select("sample").distinct(), "sample", lg.trim_summary(latest, "sample"), viewed, bought=events.where("event_type = 'purchase'"))
    return out.select("sample", "total_reads", "aligned", lg.percent_aligned(F.col("aligned"), F.col("remaining_reads")).alias("percent_aligned"), "in_bought")


@query(f"with {READS} select chrom, count(distinct name) names from reads group by 1")
def aligned_distinct(spark: SparkSession, d: str) -> DataFrame:
    rows = reads(spark, d)
    return lg.distinct_names(rows.withColumn("value", iv.bed_line("chrom", "start", "end", "name")), ["chrom"])


@query("select doc_id, md5(text) digest from documents")
def line_md5(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", line_digest(F.col("text")).alias("digest"))


@query("select case when l_extendedprice = floor(l_extendedprice) then cast(cast(l_extendedprice as bigint) as varchar) else printf('%.6g', l_extendedprice) end as said, count(*) n from lineitem group by 1")
def number_text_g6(spark: SparkSession, d: str) -> DataFrame:
    """Numbers are counted before they are spelled, so each is spelled once."""
    counted = table(spark, d, "lineitem").groupBy("l_extendedprice").agg(F.count("*").alias("n"))
    return counted.groupBy(as_awk(F.col("l_extendedprice")).alias("said")).agg(F.sum("n").alias("n"))


@query()
def quality_trim_reads(spark: SparkSession, d: str) -> DataFrame:
    """Texts as reads and as their own qualities, with the adapter that most of them hold cut; survival by language."""
    docs = table(spark, d, "documents")
    pairs = docs.select("lang", F.col("text").alias("seq1"), F.col("text").alias("qual1"), F.reverse("text").alias("seq2"), F.reverse("text").alias("qual2"))
    adapter = tr.ADAPTERS[tr.detect_adapter(pairs, "seq1")]
    return tr.trim_report(tr.trim_pairs(pairs, adapter), ["lang"])
