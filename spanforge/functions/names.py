"""Natural order of names, and names taken from others."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def natural_key(name: Column) -> Column:
    """A text whose plain order is the natural order: digit runs compare as numbers, leading zeros apart.

    Names that differ only in leading zeros have the same key.
    """
    tokens = F.regexp_extract_all(name, F.lit("([0-9]+|[^0-9]+)"), F.lit(0))

    def padded(token: Column) -> Column:
        digits = F.regexp_replace(token, "^0+", "")
        return F.when(token.rlike("^[0-9]"), F.concat(F.lit("0"), F.lpad(F.length(digits).cast("string"), 6, "0"), digits)).otherwise(token)

    return F.array_join(F.transform(tokens, padded), "")


def pair_rank(flags: Column, before_1_20: bool = False) -> Column:
    """Order of records of one name from their flags: first, second mate; then secondary, then supplementary ones."""
    mate = F.shiftleft(flags.bitwiseAND(0xC0), 8)
    if before_1_20:
        return flags.bitwiseAND(0xC0)
    return mate + F.shiftleft(flags.bitwiseAND(0x100), 3) + F.shiftright(flags.bitwiseAND(0x800), 3)


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def mate_of(file: Column) -> Column:
    """1 or 2 from `_1` or `_2` before the ending of a FASTQ file; null for others."""
    return F.when(file.rlike(r"_1(\.filt)?\.fastq"), 1).when(file.rlike(r"_2(\.filt)?\.fastq"), 2)


def sample_of(path: Column) -> Column:
    """The directory under fastq/; empty for other paths."""
    return F.regexp_extract(path, "^fastq/([^/]*)", 1)


def filtered_name(file: Column) -> Column:
    """Name of the filtered copy of a mate's file; an error for a name without a mate."""
    named = F.regexp_replace(file, r"^(.*?)_([12])\.fastq", r"$1_$2_filtered.fastq")
    return F.when(file.rlike(r"_[12]\.fastq"), named).otherwise(F.raise_error(F.concat(F.lit("no mate number in "), file)).cast("string"))


def secure_url(url: Column) -> Column:
    return F.regexp_replace(url, "^ftp://", "https://")
