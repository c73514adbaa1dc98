"""The test tables seen as domains, reads, alignments, logs and lists; each view in Spark and, alike, in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spanforge.tables import table


def domains(spark: SparkSession, d: str) -> DataFrame:
    """Parts as domains, and suppliers as domains of a chromosome on which no read lies."""
    unread = table(spark, d, "supplier").selectExpr(
        "concat('unread_', s_suppkey) name", "'chrU' chrom", "s_suppkey * 1000 start", "s_suppkey * 1000 + 500 end"
    )
    return table(spark, d, "part").selectExpr(
        "concat(case when p_size <= 10 then 'baseline_' else 'dom_' end, p_partkey) name", "concat('chr', p_partkey % 24) chrom",
        "(p_partkey div 24) * 1000 start", "(p_partkey div 24) * 1000 + 200 + 20 * p_size end",
    ).unionByName(unread)


DOMAINS = """domains as (select case when p_size <= 10 then 'baseline_' else 'dom_' end || p_partkey as name, 'chr' || (p_partkey % 24) chrom,
  (p_partkey // 24) * 1000 as s, (p_partkey // 24) * 1000 + 200 + 20 * p_size as e from part
  union all select 'unread_' || s_suppkey, 'chrU', s_suppkey * 1000, s_suppkey * 1000 + 500 from supplier)"""


def reads(spark: SparkSession, d: str) -> DataFrame:
    place = "(l_partkey div 24) * 1000 + (7 * l_suppkey) % 600 + 13 * l_linenumber"
    return table(spark, d, "lineitem").selectExpr(
        "concat('chr', l_partkey % 24) chrom", f"{place} start", f"{place} + cast(l_quantity as bigint) * 5 end",
        "concat('r', l_orderkey) name", "l_linenumber score", "case when l_returnflag = 'R' then '-' else '+' end strand",
    )


READS = """reads as (select 'chr' || (l_partkey % 24) chrom, (l_partkey // 24) * 1000 + (7 * l_suppkey) % 600 + 13 * l_linenumber as s,
  (l_partkey // 24) * 1000 + (7 * l_suppkey) % 600 + 13 * l_linenumber + cast(l_quantity as bigint) * 5 as e,
  'r' || l_orderkey as name, l_linenumber score, case when l_returnflag = 'R' then '-' else '+' end strand from lineitem)"""

_FLAGS = (
    "cast(case when l_linenumber = 5 then 0 else 1 end + case when l_returnflag = 'N' and l_partkey % 5 = 0 then 4 else 0 end"
    " + case when l_linenumber % 2 = 0 then 16 else 0 end + case when l_linenumber % 2 = 1 then 64 else 128 end"
    " + case when l_quantity = 1 then 256 else 0 end + case when l_quantity = 2 then 2048 else 0 end as int)"
)
_ORDER = "((l_linenumber * cast(10000000 as bigint) + l_partkey) * 100000 + l_suppkey) * 100 + cast(l_quantity as bigint)"
_PLACE = "(l_orderkey {div} 24) * 1000 + l_partkey % 400"


_SAMPLE = "case when l_suppkey % 10 < 6 then 'hot' else concat('s', l_suppkey % 3) end"


def alignments(spark: SparkSession, d: str) -> DataFrame:
    place = _PLACE.format(div="div")
    return table(spark, d, "lineitem").selectExpr(
        f"{_SAMPLE} sample", f"{_ORDER} ord", "concat('o', l_orderkey) name", f"{_FLAGS} flags",
        "concat('chr', case when l_suppkey % 10 = 0 then l_suppkey % 24 else l_orderkey % 24 end) chrom",
        f"{place} start", f"{place} + 50 + cast(l_quantity as bigint) end", "cast(l_partkey % 61 as int) mapq",
    )


ALIGNMENTS = f"""alignments as (select {_SAMPLE} smp, {_ORDER} ord, l_orderkey k, 'o' || l_orderkey as name, {_FLAGS} flags,
  'chr' || (case when l_suppkey % 10 = 0 then l_suppkey % 24 else l_orderkey % 24 end) chrom,
  {_PLACE.format(div='//')} as s, {_PLACE.format(div='//')} + 50 + cast(l_quantity as bigint) as e, cast(l_partkey % 61 as int) mapq from lineitem)"""

RANK = "((flags & 192) << 8) + ((flags & 256) << 3) + ((flags & 2048) >> 3)"


def pairs_sql(by: str = "") -> str:
    """Mates in SQL; by: `smp, ` for a stream of each sample."""
    same = " and a.smp = b.smp" if by else ""
    on = " and p.smp = a.smp" if by else ""
    return f"""{ALIGNMENTS},
n as (select *, row_number() over (partition by {by}k order by {RANK}, ord) rn from alignments where flags & 2304 = 0),
sizes as (select {by}k, count(*) % 2 = 1 as odd from n group by {by}k),
before as (select {by}k, lag(odd, 1, false) over ({"partition by smp " if by else ""}order by k) after_odd from sizes),
ends as (select smp, k, rn, name, flags, mapq, flags & 4 = 0 mapped, case when flags & 4 = 0 then chrom else '.' end c,
  case when flags & 4 = 0 then s else -1 end st, case when flags & 4 = 0 then e else -1 end en,
  case when flags & 4 <> 0 then '.' when flags & 16 = 0 then '+' else '-' end sd from n),
two as (select a.*, b.c c2, b.st st2, b.en en2, b.sd sd2, case when a.mapped and b.mapped then least(a.mapq, b.mapq) else 0 end sc,
  a.c > b.c or (a.c = b.c and a.st > b.st) as swap
  from ends a join ends b on a.k = b.k and a.rn % 2 = 1 and b.rn = a.rn + 1{same} join before p on p.k = a.k{on}
  where (a.flags & 1 = 1 and b.flags & 1 = 1) or (a.rn = 1 and p.after_odd)),
pairs as (select {by}case when swap then c2 else c end chrom1, case when swap then st2 else st end start1, case when swap then en2 else en end end1,
  case when swap then c else c2 end chrom2, case when swap then st else st2 end start2, case when swap then en else en2 end end2,
  name, sc score, case when swap then sd2 else sd end strand1, case when swap then sd else sd2 end strand2 from two)"""


PAIRS = pairs_sql()


def proper_sql(ceiling: str) -> str:
    return (
        "(chrom1 <> '.' and chrom2 <> '.' and chrom1 = chrom2 and strand1 <> strand2 and start2 - end1 <= " + ceiling + " and "
        "((start1 >= start2 and start1 <= end2) or (end1 >= start2 and end1 <= end2) or start1 <= start2))"
    )


def stats_sql(by: str = "") -> str:
    """Distribution of the distances; by: `smp, ` for one of each sample."""
    group = " group by smp" if by else ""
    using = " using (smp)" if by else " on true"
    return f"""{pairs_sql(by)},
d as (select {by}cast(start2 - end1 as bigint) x from pairs where {proper_sql('800')}),
m as (select {by}count(*) n, cast(round_even(avg(x), 0) as bigint) mean from d{group}),
v as (select {by}sum((x - mean) * (x - mean)) q from d join m{using}{group}),
stats as (select {by}mean, cast(round_even(sqrt(q / n), 0) as bigint) sd, n from m join v{using})"""


def fragments_sql(by: str = "") -> str:
    """Fragments without extension; by: `smp, ` for those of each sample."""
    using = " using (smp)" if by else " on true"
    return f"""{stats_sql(by)}, x as (select pairs.*, mean + 5 * sd as ceiling from pairs join stats{using}), y as (select *, {proper_sql('ceiling')} ok from x),
fragments as (select {by}chrom1 as chrom, least(start1, start2) as s, greatest(end1, end2) as e, name, score, strand1 as strand from y where ok
  union all select {by}chrom1, greatest(start1, 0), end1, name, score, strand1 from y where not ok and chrom1 <> '.'
  union all select {by}chrom2, greatest(start2, 0), end2, name, score, strand2 from y where not ok and chrom2 <> '.')"""


STATS = stats_sql()


def trim_rows(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").selectExpr(
        "event_id ord", "concat('fastq/u', user_id, '/f', event_id % 3) file",
        "case when event_type in ('click', 'view', 'signup') then 'total' else 'discarded' end kind", "cast(floor(value * 100) as bigint) reads",
    )


TRIM_ROWS = """t as (select event_id ord, 'fastq/u' || user_id || '/f' || (event_id % 3) as file, 'u' || user_id as sample,
  case when event_type in ('click', 'view', 'signup') then 'total' else 'discarded' end kind, cast(floor(value * 100) as bigint) reads from events)"""
