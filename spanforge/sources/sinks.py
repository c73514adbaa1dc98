"""Writing results as text."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanforge.functions.numbers import as_awk, as_r
from spanforge.operators.fragments import BEDPE


def write_lines(df: DataFrame, path: str, line: Column, compress: bool = False, mode: str = "errorifexists", single: bool = False) -> None:
    """A directory of text parts, or one part if `single` (for small results); gzip if compressed."""
    lines = df.select(line.alias("value"))
    (lines.coalesce(1) if single else lines).write.mode(mode).option("compression", "gzip" if compress else "none").text(path)


def tabbed(*columns: Column) -> Column:
    return F.concat_ws("\t", *[F.coalesce(c.cast("string"), F.lit("NA")) for c in columns])


def write_intervals(df: DataFrame, path: str, **how) -> None:
    write_lines(df, path, tabbed(*[F.col(c) for c in ("chrom", "start", "end", "name", "score", "strand")]), **how)


def write_pairs(df: DataFrame, path: str, **how) -> None:
    """The ten BEDPE columns of pairs."""
    write_lines(df, path, tabbed(*[F.col(c) for c in BEDPE]), **how)


def write_read_depth(df: DataFrame, path: str, **how) -> None:
    """name and depth, numbers as awk prints them."""
    write_lines(df, path, tabbed(F.col("name"), as_awk(F.col("depth"))), **how)


CORRECTED = ["domain", "coverage", "percent_gc", "k_gc", "corrected_coverage"]


def corrected_line() -> Column:
    """A line of the corrected table, numbers as R writes them."""
    return tabbed(F.col("domain"), *[as_r(F.col(c)) for c in CORRECTED[1:]])


def write_corrected(df: DataFrame, path: str, order: list[str] = (), **how) -> None:
    """The corrected table in the given order, its header in the first part: parts follow each other like their rows."""
    keys = [F.col(c).alias(f"__{i}") for i, c in enumerate(order)]
    body = df.select(F.lit(1).alias("__o"), *keys, corrected_line().alias("value"))
    head = df.sparkSession.range(1).select(F.lit(0).alias("__o"), F.lit("\t".join(n.replace("_", ".") for n in CORRECTED)).alias("value"))
    rows = body.unionByName(head, allowMissingColumns=True).orderBy("__o", *[f"__{i}" for i in range(len(keys))])
    write_lines(rows, path, F.col("value"), **how)


def write_fasta(df: DataFrame, path: str, with_place: bool = False, **how) -> None:
    """Records of name and seq; with_place adds ::chrom:start-end to the names."""
    name = F.concat(F.col("name"), F.lit("::"), F.col("chrom"), F.lit(":"), F.col("start").cast("string"), F.lit("-"), F.col("end").cast("string"))
    write_lines(df, path, F.concat(F.lit(">"), name if with_place else F.col("name"), F.lit("\n"), F.col("seq")), **how)


def append_trim_log(df: DataFrame, path: str) -> None:
    """Two lines for each pair of files: its pairs, and those discarded. Appends are committed as a whole."""
    kinds = F.explode(F.array(F.struct(F.lit("total").alias("k"), F.col("pairs_in").alias("n")), F.struct(F.lit("discarded").alias("k"), (F.col("pairs_in") - F.col("pairs_out")).alias("n"))))
    write_lines(df.select("file", kinds.alias("x")), path, tabbed(F.col("file"), F.col("x.k"), F.col("x.n")), mode="append")


def corrected_name(depth_name: str) -> str:
    """Name of the corrected table of a depth file; other names stay."""
    return re.sub("_read.depth.bed", "_gc_correct.txt", depth_name, count=1)


def packed_name(name: str, compress: bool) -> str:
    bare = name.removesuffix(".gz")
    return bare + ".gz" if compress else bare
