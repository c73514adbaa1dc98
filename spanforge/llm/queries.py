"""Queries p1, p6, p7 and p8 over the whole test tables, and SQL that gives the same rows where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanforge.checkpoints import cut, small_side
from spanforge.llm import encode, lookalike, packing, sampling
from spanforge.tables import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    report = sampling.target_report(table(spark, d, "candidate"), table(spark, d, "sampling_target"))
    return report.where("scarce > 0").select("release_tag", "dim", "category")


def p1_report(spark: SparkSession, d: str) -> DataFrame:
    report = sampling.target_report(table(spark, d, "candidate"), table(spark, d, "sampling_target"))
    return report.select("release_tag", "dim", "category", "wanted", "available", "scarce")


def p1_unmet(spark: SparkSession, d: str) -> DataFrame:
    """Targets that cannot be met: for want of rows, or because the other dimension keeps rows out that exist."""
    report = sampling.target_report(table(spark, d, "candidate"), table(spark, d, "sampling_target"))
    return report.where("scarce > 0 or conflict > 0").select("release_tag", "dim", "category", "wanted", "available", "scarce", "conflict")


def p1_conflict(spark: SparkSession, d: str) -> DataFrame:
    """Wanted rows of each release that exist and cannot be had together."""
    report = sampling.target_report(table(spark, d, "candidate"), table(spark, d, "sampling_target"))
    return report.groupBy("release_tag").agg(F.sum("conflict").alias("conflict"))


def p1_sample_check(spark: SparkSession, d: str) -> DataFrame:
    """The sample's size by release, rows drawn twice, and rows that are no candidates."""
    candidates = table(spark, d, "candidate")
    drawn = sampling.matched_sample(candidates, table(spark, d, "sampling_target"))
    known = candidates.select("release_tag", "candidate_id").distinct().withColumn("known", F.lit(True))
    return drawn.join(known, ["release_tag", "candidate_id"], "left").groupBy("release_tag").agg(
        F.count("*").alias("drawn"), (F.count("*") - F.countDistinct("candidate_id")).alias("repeated"), F.count(F.when(F.col("known").isNull(), 1)).alias("unknown")
    )


def p1_sample(spark: SparkSession, d: str) -> DataFrame:
    return sampling.matched_sample(table(spark, d, "candidate"), table(spark, d, "sampling_target"))


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode.encode_corpus(table(spark, d, "documents"), keep=["doc_id"])


def p7_packing(spark: SparkSession, d: str) -> DataFrame:
    sizes = table(spark, d, "container_size")
    names = sorted(r[0] for r in sizes.select("tokenizer").distinct().collect())  # a parameter table of a few rows
    return packing.pack(packing.token_counts(table(spark, d, "documents"), names), sizes)


def p7_fill(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill_report(p7_packing(spark, d), table(spark, d, "container_size"))


def p7_check(spark: SparkSession, d: str) -> DataFrame:
    """For each container size: documents packed; containers over capacity, documents divided without need or not whole; and whether
    at most one container is no more than half full, as best fit leaves them."""
    capacity = table(spark, d, "container_size").select("size_id", F.col("capacity_tokens").cast("long").alias("capacity"))
    packed = cut(p7_packing(spark, d)).join(small_side(capacity), "size_id")
    tokens, end = F.sum("piece_tokens"), F.max(F.col("first_token") + F.col("piece_tokens"))
    docs = packed.groupBy("size_id", "capacity", "doc_id").agg(tokens.alias("t"), end.alias("e"), F.count("*").alias("n"))
    docs = docs.groupBy("size_id").agg(
        F.count("*").alias("documents"), F.count(F.when((F.col("n") > 1) & (F.col("t") <= F.col("capacity")), 1)).alias("divided_without_need"),
        F.count(F.when(F.col("t") != F.col("e"), 1)).alias("not_whole"),
    )
    full = packed.where("container_id is not null").groupBy("size_id", "capacity", "container_id").agg(tokens.alias("t")).groupBy("size_id").agg(
        F.count(F.when(F.col("t") > F.col("capacity"), 1)).alias("over"), (F.count(F.when(2 * F.col("t") <= F.col("capacity"), 1)) <= 1).alias("filled")
    )
    return docs.join(full, "size_id")


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.look_alike_pairs(table(spark, d, "documents"))


def p8_forms(spark: SparkSession, d: str) -> DataFrame:
    """The digest of every document's consistent text: the canonical member's where others look like it, else its own."""
    return lookalike.consistent_digests(table(spark, d, "documents"))


def p8_texts(spark: SparkSession, d: str) -> DataFrame:
    """Every document with its consistent text, and whether that is another than its own."""
    docs = table(spark, d, "documents").select("doc_id", "text", F.md5("text").alias("was"))
    return lookalike.consistent_texts(docs).select("doc_id", F.col("text").alias("consistent"), (F.md5("text") != F.col("was")).alias("changed"))


def queries() -> dict:
    return {f.__name__: f for f in (p1_found, p1_report, p1_unmet, p1_conflict, p1_sample, p1_sample_check, p6_ids, p7_packing, p7_fill, p7_check, p8_found, p8_forms, p8_texts)}


_P1 = """
with want as (
  select release_tag, dim, category, upper(trim(category, ' ')) cat,
         greatest(min_rows, cast(ceil(cast(sample_size as decimal(18,0)) * share_bp / 10000) as bigint)) wanted
  from sampling_target),
long as (
  select release_tag, candidate_id, 'population' dim, upper(trim(population, ' ')) cat from candidate
  union all
  select release_tag, candidate_id, 'centre_name', upper(trim(centre_name, ' ')) from candidate),
has as (
  select release_tag, dim, cat, count(distinct candidate_id) available from long
  where cat is not null and cat not in ('', 'NA') group by 1, 2, 3)
select w.release_tag, w.dim, w.category, {columns}
from want w left join has h on h.release_tag = w.release_tag and h.dim = w.dim and h.cat = w.cat
"""


# The most rows that answer a target of either dimension at once are a minimal cut: over all sets of centres, what the
# others want, and of each population what it wants or what it has at the centres of the set.
_P1_CONFLICT = (
    "with t as (" + _P1.format(columns="cast(least(wanted, coalesce(available, 0)) as bigint) had, w.cat cat") + """),
once as (
  select release_tag, upper(trim(population, ' ')) p, upper(trim(centre_name, ' ')) c from candidate where candidate_id is not null
  qualify row_number() over (partition by release_tag, candidate_id order by upper(trim(population, ' ')) nulls first, upper(trim(centre_name, ' ')) nulls first) = 1),
cell as (select release_tag, p, c, count(*) n from once group by 1, 2, 3),
centre as (select release_tag, cat, had, row_number() over (partition by release_tag order by cat) - 1 as k from t where dim = 'centre_name'),
sets as (select release_tag, unnest(range(0, cast(pow(2, count(*)) as bigint))) s from centre group by 1),
outside as (select s.release_tag, s.s, coalesce(sum(had) filter ((s.s >> k) & 1 = 0), 0) o from sets s join centre c on s.release_tag = c.release_tag group by 1, 2),
inside as (
  select s.release_tag, s.s, t.cat, least(t.had, coalesce(sum(x.n) filter ((s.s >> c.k) & 1 = 1), 0)) i
  from sets s join t on t.release_tag = s.release_tag and t.dim = 'population' join centre c on c.release_tag = s.release_tag
  left join cell x on x.release_tag = s.release_tag and x.p = t.cat and x.c = c.cat group by 1, 2, 3, t.had),
cuts as (select o.release_tag, min(o.o + coalesce(i.i, 0)) most from outside o
  left join (select release_tag, s, sum(i) i from inside group by 1, 2) i on i.release_tag = o.release_tag and i.s = o.s group by 1)
select t.release_tag, cast(sum(t.had) - 2 * max(coalesce(most, 0)) as bigint) as conflict from t left join cuts on t.release_tag = cuts.release_tag group by 1
"""
)
_P1_SIZES = """
with w as (select release_tag, max(sample_size) size from sampling_target group by 1),
h as (select release_tag, count(distinct candidate_id) n from candidate group by 1)
select release_tag, cast(least(size, n) as bigint) drawn, cast(0 as bigint) repeated, cast(0 as bigint) as unknown
from w join h using (release_tag) where least(size, n) > 0
"""


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": "select release_tag, dim, category from (" + _P1.format(columns="wanted, coalesce(available, 0) available") + ") where wanted > available",
        "p1_report": _P1.format(
            columns="cast(wanted as bigint) wanted, cast(coalesce(available, 0) as bigint) available, "
            "cast(greatest(wanted - coalesce(available, 0), 0) as bigint) scarce"
        ),
        "p7_check": """select size_id, (select count(*) from documents) documents, cast(0 as bigint) divided_without_need, cast(0 as bigint) not_whole,
            cast(0 as bigint) as over, true filled from container_size""",
        "p1_conflict": _P1_CONFLICT,
        "p1_sample_check": _P1_SIZES,
    }
