"""Files as rows: digests, counts and listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def listed(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """path, length of files with a suffix, without reading them."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*" + suffix).option("recursiveFileLookup", "true").load(path).select("path", "length")


def gathered(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """Compressed files with a suffix, or the plain ones if there are none."""
    packed = listed(spark, path, suffix + ".gz")
    return packed if packed.limit(1).count() else listed(spark, path, suffix)


def line_counts(lines: DataFrame, expected: DataFrame, file: str = "file") -> DataFrame:
    """expected with `lines`: the number of lines of each file, matched by base name; null for one that is absent or empty.

    lines: file and value of a folder's files, see sources.lines.text_lines.
    For records of BAM files see sources.alignments.bam_counts.
    """
    have = lines.groupBy(F.substring_index("file", "/", -1).alias("__name")).agg(F.count("value").alias("lines"))
    return expected.join(have, F.substring_index(F.col(file), "/", -1) == F.col("__name"), "left").drop("__name")


def digests(spark: SparkSession, path: str) -> DataFrame:
    """path, bytes, lines, md5, sha256 of each file."""
    files = spark.read.format("binaryFile").load(path)
    text = F.col("content").cast("string")
    lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    return files.select("path", F.col("length").alias("bytes"), lines.alias("lines"), F.md5("content").alias("md5"), F.sha2("content", 256).alias("sha256"))


def verified(files: DataFrame, expected: DataFrame, file: str = "file", digest: str = "md5") -> DataFrame:
    """expected with `state`: ok, differs or absent; files are matched by their base name."""
    have = files.select(F.substring_index("path", "/", -1).alias("__name"), F.col(digest).alias("__have"))
    out = expected.join(have, F.substring_index(F.col(file), "/", -1) == F.col("__name"), "left")
    state = F.when(F.col("__have").isNull(), "absent").when(F.lower("__have") == F.lower(digest), "ok").otherwise("differs")
    return out.withColumn("state", state).drop("__name", "__have")


def line_digest(line: Column) -> Column:
    """MD5 of a line's bytes, in lower-case hexadecimal digits."""
    return F.md5(line)
