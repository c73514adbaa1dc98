"""References to records that do not exist at their time.

Everything is kept as signed counts per key and day: how many references came,
and by how much the number of existing records rose or fell.  Such a ledger is
a sum of change deltas, so a later batch is added to it instead of recomputing
it.  References on days without a change of their key are judged by the ledger
alone; only those on a day of change are compared with the changes themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from spanforge.checkpoints import cut

#: References of one key and day of change that are compared with its changes in one task.
ROWS_PER_PART = 50_000


def _day(at: Column) -> Column:
    """Day of a time; those without one come before all others."""
    return F.coalesce(F.to_date(at), F.lit("0001-01-01").cast("date"))


def _sign(sign: str | None) -> Column:
    return (F.lit(1) if sign is None else F.col(sign)).cast("long")


def existence_deltas(records: DataFrame, name: str, added: str, deleted: str) -> DataFrame:
    """name, at, delta: +1 where a record begins to exist, -1 where it ends. Records that end before they begin have none."""
    lives = records.where(F.col(name).isNotNull() & F.col(added).isNotNull() & (F.col(deleted).isNull() | (F.col(deleted) > F.col(added))))
    return lives.select(
        F.col(name).alias("name"),
        F.explode(F.array(F.struct(F.col(added).alias("at"), F.lit(1).alias("delta")), F.struct(F.col(deleted).alias("at"), F.lit(-1).alias("delta")))).alias("x"),
    ).select("name", "x.at", "x.delta").where("at is not null")


def reference_deltas(refs: DataFrame, name: str = "name", at: str = "at", sign: str | None = None) -> DataFrame:
    """Rows of a ledger for references; null names refer to nothing. sign: 1 for one that comes, -1 for one taken back."""
    nothing, none = F.lit(0).cast("long"), F.lit(None).cast(dict(refs.dtypes)[at])
    return refs.where(F.col(name).isNotNull()).select(
        F.col(name).alias("name"), _day(F.col(at)).alias("day"), _sign(sign).alias("refs"), nothing.alias("delta"), nothing.alias("moves"),
        none.alias("first_added"), F.lit(False).alias("undated"),
    )


def record_deltas(
    records: DataFrame, name: str = "name", added: str = "added_at", deleted: str = "deleted_at", sign: str | None = None
) -> DataFrame:
    """Rows of a ledger for records: when they begin and cease to exist, and that their name is known.

    sign: 1 for a state that holds from now on, -1 for one that it replaces.  A
    record deleted later on comes as its old state with -1 and its new one with
    1.  Its name stays known, and so does the time when it was first added.
    """
    nothing, none = F.lit(0).cast("long"), F.lit(None).cast(dict(records.dtypes)[added])
    lives = records.where(F.col(name).isNotNull() & F.col(added).isNotNull() & (F.col(deleted).isNull() | (F.col(deleted) > F.col(added))))
    ends = F.array(F.struct(F.col(added).alias("at"), F.lit(1).alias("by")), F.struct(F.col(deleted).alias("at"), F.lit(-1).alias("by")))
    moves = lives.select(F.col(name).alias("name"), _sign(sign).alias("__sign"), F.explode(ends).alias("x")).where("x.at is not null").select(
        "name", _day(F.col("x.at")).alias("day"), nothing.alias("refs"), (F.col("x.by") * F.col("__sign")).alias("delta"), F.col("__sign").alias("moves"),
        none.alias("first_added"), F.lit(False).alias("undated"),
    )
    known = records.where(F.col(name).isNotNull()).select(
        F.col(name).alias("name"), _day(F.col(added)).alias("day"), nothing.alias("refs"), nothing.alias("delta"), nothing.alias("moves"),
        F.col(added).alias("first_added"), F.col(added).isNull().alias("undated"),
    )
    return moves.unionByName(known)


def reference_ledger(refs: DataFrame, records: DataFrame, name: str = "name", at: str = "at", added: str = "added_at", deleted: str = "deleted_at") -> DataFrame:
    """name, day, refs, delta, moves, first_added, undated: signed counts of references and existence per key and day.

    Map-side sums come before the only shuffle.  Null names refer to nothing.
    """
    return summed(reference_deltas(refs, name, at).unionByName(record_deltas(records, name, added, deleted)))


def summed(rows: DataFrame) -> DataFrame:
    """A ledger of rows of deltas, or of several ledgers."""
    return rows.groupBy("name", "day").agg(
        F.sum("refs").alias("refs"), F.sum("delta").alias("delta"), F.sum("moves").alias("moves"),
        F.min("first_added").alias("first_added"), F.max("undated").alias("undated"),
    )


def merge_ledgers(old: DataFrame, new: DataFrame) -> DataFrame:
    """Ledger of both batches of changes."""
    return summed(old.unionByName(new))


def day_states(ledger: DataFrame) -> DataFrame:
    """name, day, refs, opening, moves, first_added, undated, known of each key and day with references that may have orphans.

    opening: records that exist as the day begins.  The window holds at most one
    row for each day of a key.
    """
    key = W.partitionBy("name")
    earlier = key.orderBy("day").rowsBetween(W.unboundedPreceding, -1)
    states = ledger.select(
        "name", "day", "refs", "moves", F.coalesce(F.sum("delta").over(earlier), F.lit(0)).alias("opening"),
        F.min("first_added").over(key).alias("first_added"), F.max("undated").over(key).alias("undated"),
    )
    states = states.withColumn("known", F.col("first_added").isNotNull() | F.col("undated"))
    return states.where("refs > 0 and (moves > 0 or opening <= 0)")


def orphan_references(
    refs: DataFrame,
    records: DataFrame,
    name: str = "name",
    at: str = "at",
    added: str = "added_at",
    deleted: str = "deleted_at",
    ledger: DataFrame | None = None,
) -> DataFrame:
    """All columns of refs and `reason` for each reference to a name that does not exist at its time.

    A record exists from `added` (included) to `deleted` (not included; null:
    for good).  reason: `missing` if no record ever had that name, `later` if
    all of them are added after the reference, otherwise `deleted`.  References
    with a null name refer to nothing; one without a time is an orphan, missing
    or deleted; a record without `added` never exists but makes its name known.
    Repeated references and records are all judged; empty tables are fine.
    ledger: a ledger that already covers both tables, if one is kept.  The days
    that may have orphans are written to the checkpoint folder, as they are
    used twice.  The references of one key and day of change are compared with
    its changes in as many parts as their number in the ledger asks for.
    """
    states = cut(day_states(reference_ledger(refs, records, name, at, added, deleted) if ledger is None else ledger))
    s = states.select(*[F.col(c).alias(f"__{c}") for c in states.columns])
    r = refs.withColumn("__at_day", _day(F.col(at)))
    held = r.join(s, (F.col(name) == F.col("__name")) & (F.col("__at_day") == F.col("__day")))
    quiet = held.where("__moves = 0")

    parts = F.ceil(F.col("refs") / ROWS_PER_PART).cast("int")
    busy = states.where("moves > 0").select("name", "day", parts.alias("parts"))
    changes = existence_deltas(records, name, added, deleted).withColumn("day", _day(F.col("at")))
    changes = changes.groupBy("name", "day", "at").agg(F.sum("delta").alias("delta")).join(busy, ["name", "day"])
    columns = refs.columns
    asked = held.where("__moves > 0").select(
        F.col("__name").alias("name"), F.col("__day").alias("day"), F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in columns]), F.ceil(F.col("__refs") / ROWS_PER_PART)).cast("int").alias("salt"),
        F.col(at).alias("at"), F.lit(0).cast("long").alias("delta"), F.struct(*[F.col(f"`{c}`") for c in columns]).alias("ref"),
        F.struct("__opening", "__first_added", "__undated").alias("state"),
    )
    spread = changes.select(
        "name", "day", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"), "at", "delta",
        F.lit(None).cast(asked.schema["ref"].dataType).alias("ref"), F.lit(None).cast(asked.schema["state"].dataType).alias("state"),
    )
    so_far = W.partitionBy("name", "day", "salt").orderBy("at", F.col("ref").isNotNull()).rowsBetween(W.unboundedPreceding, 0)
    judged = asked.unionByName(spread).withColumn("__moved", F.sum("delta").over(so_far)).where("ref is not null and state.__opening + __moved <= 0")
    judged = judged.select("ref.*", F.col("state.__first_added").alias("__first_added"), F.col("state.__undated").alias("__undated"), F.lit(True).alias("__known"))

    both = quiet.select(*[F.col(f"`{c}`") for c in columns], "__first_added", "__undated", "__known").unionByName(judged)
    later = F.coalesce((F.col(at) < F.col("__first_added")) & ~F.col("__undated"), F.lit(False))
    reason = F.when(~F.col("__known"), "missing").when(later, "later").otherwise("deleted")
    return both.withColumn("reason", reason).drop("__first_added", "__undated", "__known")
