"""Text files as lines, plain or compressed, with their place in the file."""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def text_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file, value: lines of text files; the codec follows the file's ending. A damaged file fails the read."""
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value")


def sniffed_lines(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """file, line_no, value of files whose compression their names do not tell: gzip members are recognised by content.

    Each file is one task's work; use it for files that are wrongly named.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                data = gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content
                lines = data.decode("utf-8", "replace").split("\n")
                lines = lines[:-1] if lines and lines[-1] == "" else lines
                for i in range(0, len(lines), 50_000):
                    part = lines[i : i + 50_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(part), pa.string()), pa.array(range(i, i + len(part)), pa.int64()), pa.array(part, pa.string())],
                        names=["file", "line_no", "value"],
                    )

    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "content")
    return files.mapInArrow(run, "file string, line_no long, value string")


def numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file, line_no (from 0), value.

    Lines are numbered within the blocks in which files are read; the blocks'
    line counts, a few rows for each file, give the offsets.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__id"), "value"
    )
    blocks = lines.groupBy("file", "__block").agg(F.min("__id").alias("__first"), F.count("*").alias("__n"))
    before = F.sum("__n").over(W.partitionBy("file").orderBy("__block").rowsBetween(W.unboundedPreceding, -1))
    offsets = blocks.select("file", "__block", "__first", F.coalesce(before, F.lit(0)).alias("__before"))
    return lines.join(offsets, ["file", "__block"]).select("file", (F.col("__before") + F.col("__id") - F.col("__first")).alias("line_no"), "value")


def field(line: Column, i: int, separator: str = "\t") -> Column:
    """Field i (from 0) of a line; null where there are fewer."""
    return F.get(F.split(line, separator), F.lit(i))


def integer(text: Column, otherwise: int | None = None) -> Column:
    """A whole number; null, or what is given, for a text that is none."""
    number = F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("long"))
    return number if otherwise is None else F.coalesce(number, F.lit(otherwise).cast("long"))


def intervals(lines: DataFrame, value: str = "value") -> DataFrame:
    """chrom, start, end, rest (all further fields as they are); lines without three sound fields are left out."""
    parts = F.split(F.col(value), "\t", 4)
    return lines.select(
        F.get(parts, F.lit(0)).alias("chrom"), integer(F.get(parts, F.lit(1))).alias("start"), integer(F.get(parts, F.lit(2))).alias("end"),
        F.coalesce(F.get(parts, F.lit(3)), F.lit("")).alias("rest"),
    ).where("chrom is not null and start is not null and end is not null")


def regions(lines: DataFrame, value: str = "value") -> DataFrame:
    """name, chrom, start, end of lines with a fourth field."""
    v = F.col(value)
    return lines.select(
        field(v, 3).alias("name"), field(v, 0).alias("chrom"), integer(field(v, 1)).alias("start"), integer(field(v, 2)).alias("end")
    ).where("name is not null and start is not null and end is not null and start >= 0 and end >= 0")


def pair_rows(lines: DataFrame, value: str = "value") -> DataFrame:
    """The ten BEDPE columns and line; lines with fewer fields are left out, numbers that are none count as 0."""
    v = F.col(value)
    columns = ["chrom1", "start1", "end1", "chrom2", "start2", "end2", "name", "score", "strand1", "strand2"]
    cells = [integer(field(v, i), 0).alias(c) if c[:5] in ("start", "end1", "end2") else field(v, i).alias(c) for i, c in enumerate(columns)]
    return lines.where(F.size(F.split(v, "\t")) >= 10).select(*cells, v.alias("line"))


def number_pairs(lines: DataFrame, names: tuple[str, str], value: str = "value") -> DataFrame:
    """name and number of two-column lines, after all other columns; rows whose second field is no number are left out."""
    parts = F.split(F.col(value), "\t", 2)
    number = F.trim(F.get(parts, F.lit(1))).try_cast("double")
    return lines.select(*[c for c in lines.columns if c != value], F.get(parts, F.lit(0)).alias(names[0]), number.alias(names[1])).where(F.col(names[1]).isNotNull())


def name_list(lines: DataFrame, value: str = "value") -> DataFrame:
    """Different names, one a line; blank lines are none."""
    return lines.select(F.trim(value).alias("name")).where("name <> ''").distinct()


def overlap_rows(lines: DataFrame, value: str = "value") -> DataFrame:
    """name, start, end, chrom, value of thirteen-column overlap lines; shorter ones are left out."""
    v = F.col(value)
    rows = lines.where(F.size(F.split(v, "\t")) >= 13)
    return rows.select(
        field(v, 3).alias("name"), integer(field(v, 1)).alias("start"), integer(field(v, 2)).alias("end"), field(v, 0).alias("chrom"), integer(field(v, 12)).alias("value")
    )


def trim_log(lines: DataFrame, value: str = "value") -> DataFrame:
    """file, kind, reads of three-field lines with a number."""
    v = F.col(value)
    keep = [c for c in lines.columns if c not in (value, "file")]
    return lines.select(*keep, field(v, 0).alias("file"), field(v, 1).alias("kind"), integer(field(v, 2)).alias("reads")).where("reads is not null and kind is not null")


def clean_log(lines: DataFrame, value: str = "value", marker: str = "correct number of reads") -> DataFrame:
    """sample, verified of lines that hold the marker."""
    v = F.col(value)
    rows = lines.where(F.contains(v, F.lit(marker))).select(field(v, 1).alias("sample"), field(v, 2).alias("verified"))
    return rows.where("sample is not null and verified is not null").distinct()


def align_log(lines: DataFrame, value: str = "value", ending: str = r"_sorted\.bed$") -> DataFrame:
    """sample, aligned of lines `sample count`; the ending of a file name is taken off."""
    parts = F.split(F.col(value), " ", 2)
    sample = F.regexp_replace(F.get(parts, F.lit(0)), ending, "")
    return lines.select(sample.alias("sample"), integer(F.trim(F.get(parts, F.lit(1)))).alias("aligned")).where("aligned is not null")
