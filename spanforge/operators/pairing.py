"""Alignments as intervals, and mates as pairs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from spanforge.checkpoints import cut
from spanforge.functions.names import natural_key, pair_rank

# Bits of an alignment's flags.
PAIRED, UNMAPPED, REVERSE, FIRST, SECOND, SECONDARY, SUPPLEMENTARY = 0x1, 0x4, 0x10, 0x40, 0x80, 0x100, 0x800


_RANGES = pa.schema([("of", pa.string()), ("name", pa.string()), ("range", pa.int32()), ("last_of", pa.string()), ("last", pa.bool_())])


def has(flags: Column, bits: int) -> Column:
    return flags.bitwiseAND(bits) != 0


def strand(flags: Column) -> Column:
    return F.when(has(flags, REVERSE), "-").otherwise("+")


def pairable(df: DataFrame, flags: str = "flags") -> DataFrame:
    """Without secondary and supplementary records."""
    return df.where(~has(F.col(flags), SECONDARY | SUPPLEMENTARY))


def single_intervals(df: DataFrame, by: list[str] = ()) -> DataFrame:
    """by and BED6 of each mapped record, its mate number after the name; secondary ones included."""
    f = F.col("flags")
    name = F.concat("name", F.when(has(f, FIRST), "/1").otherwise(""), F.when(has(f, SECOND), "/2").otherwise(""))
    return df.where(~has(f, UNMAPPED)).select(
        *by, F.coalesce("chrom", F.lit(".")).alias("chrom"), "start", "end", name.alias("name"), F.col("mapq").alias("score"), strand(f).alias("strand")
    )


def in_name_order(df: DataFrame, name: str = "name", flags: str = "flags", ord: str = "ord") -> DataFrame:
    """Natural name order, mates by their rank, equal ones as they came."""
    return df.orderBy(natural_key(F.col(name)), pair_rank(F.col(flags)), ord)


def _end(prefix: str) -> Column:
    mapped = ~has(F.col(f"{prefix}.flags"), UNMAPPED)
    return F.when(
        mapped,
        F.struct(
            F.coalesce(F.col(f"{prefix}.chrom"), F.lit(".")).alias("chrom"), F.col(f"{prefix}.start").alias("start"),
            F.col(f"{prefix}.end").alias("end"), strand(F.col(f"{prefix}.flags")).alias("strand"),
        ),
    ).otherwise(F.struct(F.lit(".").alias("chrom"), F.lit(-1).cast("long").alias("start"), F.lit(-1).cast("long").alias("end"), F.lit(".").alias("strand")))


def block_ordered(pairs: DataFrame, by: list[str] = ()) -> DataFrame:
    """by and BEDPE of rows with name and structs `one` and `two` (flags, chrom, start, end, mapq).

    The end on the lesser chromosome name, then of the lesser start, comes
    first; ties on both keep the records' order.  The name is the first
    record's; the score is the lesser quality, 0 unless both are mapped.
    """
    both = ~has(F.col("one.flags"), UNMAPPED) & ~has(F.col("two.flags"), UNMAPPED)
    ends = pairs.withColumn("__a", _end("one")).withColumn("__b", _end("two"))
    swap = (F.col("__a.chrom") > F.col("__b.chrom")) | ((F.col("__a.chrom") == F.col("__b.chrom")) & (F.col("__a.start") > F.col("__b.start")))
    first, second = F.when(swap, F.col("__b")).otherwise(F.col("__a")), F.when(swap, F.col("__a")).otherwise(F.col("__b"))
    ends = ends.withColumn("__x", first).withColumn("__y", second)
    return ends.select(
        *by, F.col("__x.chrom").alias("chrom1"), F.col("__x.start").alias("start1"), F.col("__x.end").alias("end1"),
        F.col("__y.chrom").alias("chrom2"), F.col("__y.start").alias("start2"), F.col("__y.end").alias("end2"),
        "name", F.when(both, F.least("one.mapq", "two.mapq")).otherwise(0).alias("score"),
        F.col("__x.strand").alias("strand1"), F.col("__y.strand").alias("strand2"),
    )


def _coupled(df: DataFrame, ord: str, by: list[str]) -> DataFrame:
    """by, name, couple (0, 1, ...), odd (whether the name leaves a record over), one, two (null for the record left over).

    One sort of the records of a name: each odd record looks one ahead.
    """
    name = W.partitionBy(*by, "name")
    mates = name.orderBy(pair_rank(F.col("flags")), ord)
    record = F.struct("flags", "chrom", "start", "end", "mapq")
    numbered = pairable(df).select(
        *by, "name", F.row_number().over(mates).alias("__rn"), (F.count("*").over(name) % 2 == 1).alias("odd"), record.alias("one"),
        F.lead(record).over(mates).alias("two"),
    )
    return numbered.where("__rn % 2 = 1").withColumn("couple", F.expr("(__rn - 1) div 2")).drop("__rn")


def _names_after_leftover(names: DataFrame) -> DataFrame:
    """of, name: those whose predecessor in natural order is odd; names: `of` (a text), `name`, different in both, and `odd`.

    Names of one `of` are in one order.  They are sorted in ranges, each of
    them about as large as the others whatever the names have in common.  A
    range looks back within itself; of its ends one row goes on, with its first
    name and the last one's `odd`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, last = None, (None, False)
        for batch in batches:
            if not batch.num_rows:
                continue
            of, name, odd = batch.column("of"), batch.column("name"), batch.column("odd").to_numpy(zero_copy_only=False)
            if first is None:
                first = (of[0].as_py(), name[0].as_py())
            same = np.concatenate([[last[0] == of[0].as_py()], pc.equal(of.slice(1), of.slice(0, len(of) - 1)).to_numpy(zero_copy_only=False)])
            after = pa.array(np.concatenate([[last[1]], odd[:-1]]) & same)
            last = (of[-1].as_py(), bool(odd[-1]))
            of, name = of.filter(after).cast(pa.string()), name.filter(after).cast(pa.string())
            none = [pa.nulls(len(of), t) for t in (pa.int32(), pa.string(), pa.bool_())]
            yield pa.RecordBatch.from_arrays([of, name, *none], schema=_RANGES)
        if first is not None:
            end = {"of": [first[0]], "name": [first[1]], "range": [TaskContext.get().partitionId()], "last_of": [last[0]], "last": [last[1]]}
            yield pa.RecordBatch.from_pydict(end, schema=_RANGES)

    keyed = names.select("of", "name", "odd", natural_key(F.col("name")).alias("__key"))
    ranged = keyed.repartitionByRange("of", "__key", "name").sortWithinPartitions("of", "__key", "name")
    found = cut(ranged.select("of", "name", "odd").mapInArrow(run, "of string, name string, range int, last_of string, last boolean"))
    ranges = W.orderBy("range")
    ends = found.where("range is not null").select("of", "name", F.lag("last_of").over(ranges).alias("of_before"), F.lag("last").over(ranges).alias("before"))
    return found.where("range is null").select("of", "name").unionByName(ends.where("before and of = of_before").select("of", "name"))


def mate_pairs(df: DataFrame, ord: str = "ord", after_leftover: bool = True, by: list[str] = ()) -> DataFrame:
    """by and BEDPE of the mates in a name-sorted stream read two at a time, a stream for each value of `by`.

    Records of a name pair up (1, 2), (3, 4), ...; an odd one is left over.  A
    pair is given if both its records are flagged as paired.  after_leftover:
    also the first pair of a name whose predecessor in name order left a record
    over, as a reader that skips forward to the next equal names gives it
    without looking at the flags.  Names are put in order only if there is such
    a pair.  What the records of each name give is written to the checkpoint
    folder, so results may be read twice.
    """
    by = list(by)
    flagged = has(F.col("one.flags"), PAIRED) & has(F.col("two.flags"), PAIRED)
    couples = _coupled(df, ord, by).withColumn("flagged", F.when(F.col("two").isNotNull(), flagged))  # null for a record left over
    if not after_leftover:
        return cut(block_ordered(couples.where("flagged"), by))
    marks = ["couple", "odd", "flagged"]
    couples = cut(block_ordered(couples.where("couple = 0 or flagged"), by + marks))
    pairs, first = couples.where("flagged").drop(*marks), couples.where("not flagged")
    if first.isEmpty():
        return pairs
    of = F.coalesce(F.to_json(F.struct(*by)), F.lit("")) if by else F.lit("")
    after = _names_after_leftover(couples.where("couple = 0").select(of.alias("of"), "name", "odd"))
    return pairs.unionByName(first.withColumn("of", of).join(after, ["of", "name"], "left_semi").drop("of", *marks))


def any_unflagged(df: DataFrame) -> bool:
    """Whether a record that can be paired is not flagged as paired; a scan of the flags."""
    return not pairable(df).where(~has(F.col("flags"), PAIRED)).isEmpty()


def mate_orphans(df: DataFrame, ord: str = "ord", by: list[str] = ()) -> DataFrame:
    """by, orphans: records flagged as paired that are left over by their name, the last record of all not counted."""
    by = list(by)
    left = _coupled(df, ord, by).where("two is null").select(*by, "name", has(F.col("one.flags"), PAIRED).alias("paired"))
    last = pairable(df).groupBy(*by).agg(F.max(F.struct(natural_key(F.col("name")).alias("k"), F.col("name").alias("n"))).alias("last"))
    last = last.select(*by, F.col("last.n").alias("name"))
    orphans = left.join(last, [*by, "name"], "left_anti") if by else left.join(F.broadcast(last), "name", "left_anti")  # one row
    return orphans.groupBy(*by).agg(F.count(F.when(F.col("paired"), 1)).alias("orphans"))
