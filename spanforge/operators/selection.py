"""Grouping, ranking and drawing by quota."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from spanforge.operators.logs import total


def candidate_groups(df: DataFrame, keys: list[str], reads: str, insert: str, population: str, ord: str) -> DataFrame:
    """keys, files, reads (decimal), mean_insert, population (of the first row), first: one row for each group; NaN for no insert size."""
    return df.groupBy(*keys).agg(
        F.count("*").alias("files"), F.coalesce(total(reads), F.lit(0)).cast("decimal(38,0)").alias("reads"),
        F.coalesce(F.avg(insert), F.lit(float("nan"))).alias("mean_insert"), F.min_by(population, ord).alias("population"), F.min(ord).alias("first"),
    )


def coverage_estimate(reads: Column, insert: Column, genome: float = 3.235e9) -> Column:
    return reads.cast("double") * insert / F.lit(genome)


def preference_rank(value: Column, order: list[str], equal: int = 0) -> Column:
    """Place in a list of preferences, from 1; the first `equal` ones share it; null for others."""
    place = F.array_position(F.array(*[F.lit(o) for o in order]), value)
    return F.when(place == 0, F.lit(None).cast("long")).when(place <= equal, F.lit(1).cast("long")).otherwise(place)


def best_per_group(df: DataFrame, group: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group; ranks above 1 are dropped before the shuffle as well."""
    return df.withColumn("__rank", F.row_number().over(W.partitionBy(*group).orderBy(*order))).where("__rank = 1").drop("__rank")


def fill_quotas(pool: DataFrame, wanted: DataFrame, item: str, group: str, order: list[Column], quota: int, groups: list[str] | None = None) -> DataFrame:
    """item, group, of_interest, place: items of interest whatever the quota, then others up to it in their group's order.

    Items of interest count towards their group's quota.  groups: only these
    are filled up.  place: place in the group's order among the others.
    """
    marked = pool.join(wanted.select(item).distinct().withColumn("__w", F.lit(True)), item, "left").withColumn(
        "of_interest", F.coalesce("__w", F.lit(False))
    )
    filled = marked.where("of_interest").groupBy(group).agg(F.count("*").alias("__filled"))
    others = marked.where("not of_interest")
    if groups is not None:
        others = others.where(F.col(group).isin(groups))
    ranked = others.withColumn("place", F.row_number().over(W.partitionBy(group).orderBy(*order))).where(F.col("place") <= quota)
    topped = ranked.join(filled, group, "left").where(F.col("place") + F.coalesce("__filled", F.lit(0)) <= quota)
    keep = [item, group, "of_interest"]
    return marked.where("of_interest").select(*keep, F.lit(0).alias("place")).unionByName(topped.select(*keep, "place"))


def without(df: DataFrame, names: DataFrame, item: str) -> DataFrame:
    """Rows whose item is in no list of names; null items stay."""
    return df.join(names.select(item).where(F.col(item).isNotNull()), item, "left_anti")


def union_of_lists(*lists: DataFrame) -> DataFrame:
    """Different names of all lists."""
    out = lists[0]
    for other in lists[1:]:
        out = out.unionByName(other)
    return out.distinct()


def listed_first(listed: DataFrame, found: DataFrame, item: str, ord: str) -> DataFrame:
    """item, index, ord: listed items with their one-based place, then those only found, without one."""
    l = listed.groupBy(item).agg(F.min(ord).alias("__o"))
    l = l.select(item, F.row_number().over(W.orderBy("__o")).alias("index"), F.col("__o").alias(ord))  # a list somebody wrote
    rest = found.groupBy(item).agg(F.min(ord).alias(ord)).join(l.select(item), item, "left_anti")
    return l.unionByName(rest.select(item, F.lit(None).cast("int").alias("index"), ord))


def repeated(df: DataFrame, item: str) -> DataFrame:
    """item, n of items that occur more than once."""
    return df.groupBy(item).agg(F.count("*").alias("n")).where("n > 1")
