"""Queries p2 to p5 over the whole test tables, and SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanforge.operators.copies import bare_name, differences
from spanforge.operators.records import parsed_records
from spanforge.operators.references import orphan_references
from spanforge.operators.stretches import bare_chrom, gaps, stretches
from spanforge.tables import table

CORRECTED = ["coverage", "percent_gc", "k_gc", "corrected_coverage"]


def _differences(spark: SparkSession, d: str) -> DataFrame:
    sides = []
    for name in ("corrected", "corrected_mirror"):
        rows = table(spark, d, name).select("sample_name", bare_name(F.col("domain")).alias("domain"), *CORRECTED, "loaded_at", "row_id")
        sides.append(rows.where("domain <> ''"))
    return differences(*sides, ["sample_name", "domain"], CORRECTED, ["loaded_at", "row_id"], only=("only_corrected", "only_mirror"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _differences(spark, d).select("sample_name", "domain", "what")


def p2_differences(spark: SparkSession, d: str) -> DataFrame:
    """Every missing row and every differing value with both values, as numbers again."""
    values = [F.col(f"{side}_value").cast("double").alias(f"{side}_value") for side in ("left", "right")]
    return _differences(spark, d).select("sample_name", "domain", "what", *values)


def p2_summary(spark: SparkSession, d: str) -> DataFrame:
    """Number of differences of each kind."""
    return _differences(spark, d).groupBy("what").agg(F.count("*").alias("n"))


def _references(spark: SparkSession, d: str) -> DataFrame:
    parts = (("corrected", "row_id", "domain", "computed_at"), ("read_depth", "depth_id", "name", "measured_at"))
    a, b = (
        table(spark, d, t).select(F.lit(t).alias("src"), F.col(key).alias("row_id"), bare_name(F.col(name)).alias("name"), F.col(at).alias("at"))
        for t, key, name, at in parts
    )
    return a.unionByName(b)


def _orphans(spark: SparkSession, d: str) -> DataFrame:
    model = table(spark, d, "gc_model").select(bare_name(F.col("name")).alias("name"), "added_at", "deleted_at")
    return orphan_references(_references(spark, d), model)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _orphans(spark, d).select("src", "row_id", "reason").distinct()


def p3_by_month(spark: SparkSession, d: str) -> DataFrame:
    """Orphan references per table and month, with what became of the name."""
    once = _orphans(spark, d).select("src", "row_id", F.date_format("at", "yyyy-MM").alias("month"), "reason").distinct()
    return once.groupBy("src", "month", "reason").agg(F.count("*").alias("orphans"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return parsed_records(table(spark, d, "index_raw"), keep=["line_id"], records=False).where("reason is not null")


def p4_records(spark: SparkSession, d: str) -> DataFrame:
    """The sound lines as Records."""
    r = parsed_records(table(spark, d, "index_raw"), keep=["line_id"]).where("reason is null").select("line_id", "record.*")
    number = {c: F.expr(f"try_cast(trim({c}) as bigint)") for c in ("insert_size", "read_count")}
    return r.select(
        "line_id", "fastq_file", "run_id", "sample_name", "population", "center_name", "library_name",
        *[v.alias(c) for c, v in number.items()], F.expr("trim(withdrawn) = '1'").alias("withdrawn"), "comment",
    )


def p4_reasons(spark: SparkSession, d: str) -> DataFrame:
    """Lines by file and outcome."""
    r = parsed_records(table(spark, d, "index_raw"), keep=["file_name"], records=False)
    return r.groupBy("file_name", F.coalesce("reason", F.lit("loaded")).alias("outcome")).agg(F.count("*").alias("n"))


def _intervals(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "read_interval").select("sample_name", bare_chrom(F.col("chrom")).alias("chrom"), "chrom_start", "chrom_end")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return gaps(_intervals(spark, d), ["sample_name", "chrom"], "chrom_start", "chrom_end")


def p5_stretches(spark: SparkSession, d: str) -> DataFrame:
    return stretches(_intervals(spark, d), ["sample_name", "chrom"], "chrom_start", "chrom_end")


def queries() -> dict:
    return {
        f.__name__: f
        for f in (p2_found, p2_differences, p2_summary, p3_found, p3_by_month, p4_found, p4_records, p4_reasons, p5_found, p5_stretches)
    }


def _newest_sql(name: str) -> str:
    return (
        "select sample_name, trim(split_part(domain, '::', 1), ' ') as dom, coverage, percent_gc, k_gc, corrected_coverage "
        f"from {name} where trim(split_part(domain, '::', 1), ' ') <> '' qualify row_number() over "
        "(partition by sample_name, trim(split_part(domain, '::', 1), ' ') order by loaded_at desc, row_id desc) = 1"
    )


def _differs_sql(c: str) -> str:
    x, y = f"a.{c}", f"b.{c}"
    return f"""
      select a.sample_name, a.dom, '{c}', {x}, {y} from a join b on a.sample_name is not distinct from b.sample_name and a.dom = b.dom
      where ({x} is null) <> ({y} is null)
         or case when {x} is null or {y} is null then false
                 when isnan({x}) or isnan({y}) or isinf({x}) or isinf({y}) then {x} <> {y}
                 else abs({x} - {y}) > 1e-9 * greatest(abs({x}), abs({y})) end"""


def _anti_sql(left: str, right: str, what: str) -> str:
    return (
        f"select l.sample_name, l.dom, '{what}', null::double, null::double from {left} l where not exists (select 1 from {right} r "
        "where l.sample_name is not distinct from r.sample_name and l.dom = r.dom)"
    )


_P2 = (
    f"with a as ({_newest_sql('corrected')}), b as ({_newest_sql('corrected_mirror')}), x(sample_name, domain, what, left_value, right_value) as ("
    + " union all ".join([_anti_sql("a", "b", "only_corrected"), _anti_sql("b", "a", "only_mirror"), *map(_differs_sql, CORRECTED)])
    + ") "
)
_P3 = """
with r as (select 'corrected' src, row_id, trim(split_part(domain, '::', 1), ' ') nm, computed_at t from corrected where domain is not null
           union select 'read_depth', depth_id, trim(split_part(name, '::', 1), ' '), measured_at from read_depth where name is not null),
g as (select distinct trim(split_part(name, '::', 1), ' ') nm, added_at, deleted_at from gc_model where name is not null),
f as (select r.src, r.row_id, r.t, count(g.nm) n, count(*) filter (g.added_at <= r.t and (g.deleted_at is null or r.t < g.deleted_at)) live,
             count(*) filter (g.added_at > r.t) later
      from r left join g on r.nm = g.nm group by 1, 2, 3),
x as (select src, row_id, t, case when n = 0 then 'missing' when later = n then 'later' else 'deleted' end reason from f where live = 0)
"""
_P4 = r"""
with l as (select line_id, file_name, regexp_replace(line, '\r\z', '') s from index_raw),
k as (select * from l where s <> '' and split_part(s, chr(9), 1) not in ('FASTQ_FILE', '"FASTQ_FILE"')),
f as (select *, regexp_full_match(chr(9) || s, '(\t("([^"]|"")*"|[^"\t][^\t]*|))*') sound,
             regexp_extract_all(chr(9) || s, '\t("(?:[^"]|"")*"|[^"\t][^\t]*|)', 1) raw from k),
v as (select line_id, file_name, sound, len(raw) n,
             list_transform(raw, lambda x: case when x[1] = '"' then replace(x[2:-2], '""', '"') else x end) fld from f),
c as (select *, trim(fld[18], ' ') a, trim(fld[24], ' ') b, trim(fld[21], ' ') w from v),
x as (select line_id, file_name, fld, case when not sound then 'quoting' when n <> 26 then 'columns'
        when not (a in ('', 'NA') or (regexp_full_match(a, '[0-9]+') and coalesce(try_cast(a as hugeint), 170141183460469231731687303715884105727) <= 9223372036854775807)) then 'insert_size'
        when not (b in ('', 'NA') or (regexp_full_match(b, '[0-9]+') and coalesce(try_cast(b as hugeint), 170141183460469231731687303715884105727) <= 9223372036854775807)) then 'read_count'
        when w not in ('', 'NA', '0', '1') then 'withdrawn' end reason from c)
"""
_P5 = """
with i as (select sample_name, 'chr' || regexp_replace(trim(chrom, ' '), '^(?i:chr)', '') chrom, chrom_start s, chrom_end e
           from read_interval where sample_name is not null and chrom is not null and chrom_start < chrom_end),
m as (select *, max(e) over (partition by sample_name, chrom order by s, e rows between unbounded preceding and 1 preceding) before from i)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "p2_found": _P2 + "select sample_name, domain, what from x",
        "p2_differences": _P2 + "select * from x",
        "p2_summary": _P2 + "select what, count(*) n from x group by 1",
        "p3_found": _P3 + "select distinct src, row_id, reason from x",
        "p3_by_month": _P3 + "select src, strftime(t, '%Y-%m') as month, reason, count(distinct row_id) orphans from x group by 1, 2, 3",
        "p4_found": _P4 + "select line_id, reason from x where reason is not null",
        "p4_records": _P4 + """select line_id, fld[1] fastq_file, fld[3] run_id, fld[10] sample_name, fld[11] population, fld[6] center_name,
            fld[15] library_name, try_cast(trim(fld[18], ' ') as bigint) insert_size, try_cast(trim(fld[24], ' ') as bigint) read_count,
            trim(fld[21], ' ') = '1' withdrawn, fld[23] as comment from x where reason is null""",
        "p4_reasons": _P4 + "select file_name, coalesce(reason, 'loaded') outcome, count(*) n from x group by 1, 2",
        "p5_found": _P5 + "select sample_name, chrom, before gap_start, s gap_end from m where s > before",
        "p5_stretches": _P5 + """, o as (select *, sum(case when before is null or s > before then 1 else 0 end)
            over (partition by sample_name, chrom order by s, e rows unbounded preceding) k from m)
            select sample_name, chrom, min(s) stretch_start, max(e) stretch_end from o group by sample_name, chrom, k""",
    }
