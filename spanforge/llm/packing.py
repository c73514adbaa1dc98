"""Filling containers of fixed capacity by best fit decreasing, exactly, at any number of items.

Items of one length are interchangeable, so the best-fit-decreasing packing of
all items follows from the number of items of each length alone: at most
`capacity` counts, however many items there are.  One small group per container
size runs best fit over those counts with a segment tree of remaining
capacities and emits runs ("items 400 to 899 of length 37 go two by two into
containers 1,200 to 1,449").  The items themselves are numbered and sent to
their containers by ordinary joins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from spanforge.checkpoints import cut, small_side
from spanforge.llm.pretokenize import Slices, long_parts, text_blocks
from spanforge.llm.vocabulary import DEFAULT_FOLDER, vocabulary

BLOCK_BYTES = 2 << 20
#: Rows of one window at the salted numbering; the number of salts follows from it.
ROWS_PER_SALT = 200_000
#: Item numbers that share a join key when runs are matched to items.
ORDINALS_PER_BLOCK = 256


class OpenBins:
    """Segment tree over remaining capacities; each leaf holds ranges of open containers."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.open = np.zeros(2 * self.leaves, dtype=np.int64)
        self.ranges: dict[int, list[tuple[int, int]]] = {}

    def _count(self, remaining: int, by: int) -> None:
        at = remaining + self.leaves
        while at:
            self.open[at] += by
            at >>= 1

    def add(self, remaining: int, first: int, bins: int) -> None:
        if remaining and bins:
            self.ranges.setdefault(remaining, []).append((first, bins))
            self._count(remaining, 1)

    def take(self, remaining: int) -> tuple[int, int]:
        self._count(remaining, -1)
        return self.ranges[remaining].pop()

    def tightest(self, size: int) -> int | None:
        """Smallest remaining capacity of at least size among the open containers."""
        at = size + self.leaves
        if self.open[at]:
            return size
        while at > 1:
            if not at & 1 and self.open[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.open[2 * at] else 2 * at + 1
                return at - self.leaves
            at >>= 1
        return None


def best_fit_runs(capacity: int, counts: dict[int, int]) -> Iterator[tuple[int, int, int, int, int]]:
    """(length, first item, items, first container, items per container) of best fit decreasing.

    A container that takes an item and still has room for another of the same
    length is then the tightest one, so it is filled with that length at once.
    """
    bins, made = OpenBins(capacity), 0
    for size in sorted(counts, reverse=True):
        left, item = counts[size], 0
        while left:
            room = bins.tightest(size)
            first, number = (made, -(-left // (capacity // size))) if room is None else bins.take(room)
            if room is None:
                room, made = capacity, made + number
            each = room // size
            whole = min(number, left // each)
            if whole:
                yield size, item, whole * each, first, each
                bins.add(room - each * size, first, whole)
                item, left = item + whole * each, left - whole * each
            if left and whole < number:
                yield size, item, left, first + whole, left
                bins.add(room - left * size, first + whole, 1)
                whole, left = whole + 1, 0
            if not left:
                bins.add(room, first + whole, number - whole)


def lengths(texts: pa.Array, v) -> np.ndarray:
    """Tokens of each text by a vocabulary; one long text is counted part by part."""
    prepared = v.prepare(texts.fill_null(""))
    found = []
    for part in long_parts(prepared):
        s = Slices(part, v.splitter)
        total = np.concatenate([[0], np.cumsum(v.counts(s.distinct)[s.index])])
        found.append(np.diff(total[s.doc_slices]))
    return found[0] if len(found) == 1 else np.sum(found, axis=0)


def token_counts(
    df: DataFrame, tokenizers: list[str], text: str = "text", item: str = "doc_id", folder: str = DEFAULT_FOLDER
) -> DataFrame:
    """item, tokenizer, tokens: the length of each text in tokens of each vocabulary. Null and empty texts have none."""
    source = df.select(F.col(f"`{item}`").alias("__item"), F.col(f"`{text}`").alias("__text"))
    schema = T.StructType(
        [T.StructField(item, source.schema["__item"].dataType), T.StructField("tokenizer", T.StringType()), T.StructField("tokens", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in text_blocks(batch, "__text", BLOCK_BYTES):
                for name in tokenizers:
                    counts = lengths(block.column("__text"), vocabulary(name, folder))
                    yield pa.RecordBatch.from_arrays(
                        [block.column("__item"), pa.array([name] * len(counts), pa.string()), pa.array(counts, pa.int64())],
                        names=[item, "tokenizer", "tokens"],
                    )

    return source.mapInArrow(run, schema)


def pack(counts: DataFrame, sizes: DataFrame, item: str = "doc_id") -> DataFrame:
    """Containers for items measured in tokens, for each container size.

    counts: item, tokenizer, tokens (see token_counts); sizes: size_id,
    tokenizer, capacity_tokens, a small parameter table.  Result: size_id, item,
    piece, first_token, piece_tokens, container_id.  An item within the capacity
    is one piece; a longer one is cut into pieces of exactly the capacity, each
    a container of its own, and a rest that is packed like any other item.  An
    item without tokens (null or empty text) takes no room and has a null
    container.  Repeated items are packed as often as they occur.  Rows of sizes
    with a null or non-positive capacity are ignored.
    """
    spark = counts.sparkSession
    small = sizes.select("size_id", "tokenizer", F.col("capacity_tokens").cast("int").alias("__cap")).where("__cap > 0").distinct()
    small = small_side(small)
    rows = cut(counts.select(F.col(f"`{item}`").alias("__item"), "tokenizer", "tokens", F.monotonically_increasing_id().alias("__row")))
    salts = max(8, rows.count() // ROWS_PER_SALT + 1)
    each = rows.join(small, "tokenizer")

    whole = (
        each.where(F.col("tokens") >= F.col("__cap"))
        .withColumn("piece", F.explode(F.expr("sequence(0, cast(tokens div __cap as int) - 1)")))
        .select(
            "size_id", "__item", "piece", (F.col("piece") * F.col("__cap").cast("long")).alias("first_token"),
            F.col("__cap").cast("long").alias("piece_tokens"),
            F.concat_ws("-", F.lit("whole"), "__row", "piece").alias("container_id"),
        )
    )
    none = each.where("tokens = 0").select(
        "size_id", "__item", F.lit(0).alias("piece"), F.lit(0).cast("long").alias("first_token"),
        F.lit(0).cast("long").alias("piece_tokens"), F.lit(None).cast("string").alias("container_id"),
    )

    key = ["size_id", "__size"]
    rest = (
        each.withColumn("__size", (F.col("tokens") % F.col("__cap")).cast("int"))
        .where("__size > 0")
        .withColumn("__salt", F.pmod(F.xxhash64("__row"), F.lit(salts)).cast("int"))
        .select(*key, "__cap", "__salt", "__item", "__row", "tokens")
    )
    salted = cut(rest.groupBy(*key, "__cap", "__salt").agg(F.count("*").alias("__n")))
    before = salted.withColumn(
        "__before", F.coalesce(F.sum("__n").over(W.partitionBy(*key).orderBy("__salt").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ).select(*key, "__salt", "__before")

    def runs(key: tuple, table: pa.Table) -> pa.Table:
        cap = table.column("__cap")[0].as_py()
        found = list(best_fit_runs(cap, dict(zip(table.column("__size").to_pylist(), table.column("__n").to_pylist()))))
        columns = list(zip(*found)) or [()] * 5
        return pa.table(
            {"size_id": pa.array([key[0].as_py()] * len(found), pa.int32()), "__size": pa.array(columns[0], pa.int32())}
            | {n: pa.array(c, pa.int64()) for n, c in zip(("__from", "__items", "__bin", "__each"), columns[1:])}
        )

    planned = (
        salted.groupBy(F.col("size_id").cast("int").alias("size_id"), "__cap", "__size").agg(F.sum("__n").alias("__n"))
        .groupBy("size_id")
        .applyInArrow(runs, "size_id int, __size int, __from long, __items long, __bin long, __each long")
    )
    per = ORDINALS_PER_BLOCK
    blocks = planned.withColumn("__block", F.explode(F.expr(f"sequence(__from div {per}, (__from + __items - 1) div {per})")))
    numbered = (
        rest.withColumn("__rank", F.row_number().over(W.partitionBy(*key, "__salt").orderBy("__row")))
        .join(before, [*key, "__salt"])
        .withColumn("__ord", F.col("__before") + F.col("__rank") - 1)
        .withColumn("__block", F.expr(f"__ord div {per}"))
    )
    packed = (
        numbered.join(blocks, [*key, "__block"])
        .where("__ord >= __from and __ord < __from + __items")
        .select(
            "size_id", "__item", F.expr("cast(tokens div __cap as int)").alias("piece"), (F.col("tokens") - F.col("__size")).alias("first_token"),
            F.col("__size").cast("long").alias("piece_tokens"),
            F.concat_ws("-", F.lit("bin"), F.expr("__bin + (__ord - __from) div __each")).alias("container_id"),
        )
    )
    return whole.unionByName(packed).unionByName(none).withColumnRenamed("__item", item)


def fill_report(packed: DataFrame, sizes: DataFrame) -> DataFrame:
    """size_id, items, pieces, containers, tokens, unused: how full the containers are."""
    by = packed.where("container_id is not null").groupBy("size_id", "container_id").agg(
        F.sum("piece_tokens").alias("t"), F.count("*").alias("n")
    )
    capacity = sizes.select("size_id", F.col("capacity_tokens").cast("long").alias("capacity_tokens"))
    return (
        by.groupBy("size_id").agg(F.sum("n").alias("pieces"), F.count("*").alias("containers"), F.sum("t").alias("tokens"))
        .join(small_side(capacity), "size_id")
        .select("size_id", "pieces", "containers", "tokens", (F.col("containers") * F.col("capacity_tokens") - F.col("tokens")).alias("unused"))
    )
