"""Summaries of logs and ledgers kept up to date by Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spanforge.functions.names import sample_of
from spanforge.operators.references import record_deltas, reference_deltas, summed
from spanforge.sources.lines import trim_log


def trim_log_stream(spark: SparkSession, path: str) -> DataFrame:
    """Streaming rows file, kind, reads, at of a growing folder of trim logs; at is the time of the file they are in."""
    lines = spark.readStream.schema("value string").text(path).select("value", F.col("_metadata.file_modification_time").alias("at"))
    return trim_log(lines)


def trim_totals(stream: DataFrame) -> DataFrame:
    """sample, file, kind, reads: the latest entry of each file and kind; the state is one row for each."""
    return stream.groupBy(sample_of(F.col("file")).alias("sample"), "file", "kind").agg(F.max_by("reads", "at").alias("reads"))


def keep_ledger(
    refs: DataFrame, records: DataFrame, path: str, checkpoint: str, name: str = "name", at: str = "at", added: str = "added_at", deleted: str = "deleted_at", sign: str | None = None
) -> StreamingQuery:
    """Keeps the ledger of operators.references under path from two streams of changes, of references and of records.

    Each batch writes the sums of its own deltas, as its part of the ledger, and
    nothing else; a batch that is run again overwrites its part, so the counts
    stay exact.  A name that is added or deleted later changes the ledger like
    one that was there from the first.  sign: column of both that is -1 for what
    is taken back.
    """
    deltas = reference_deltas(refs, name, at, sign).unionByName(record_deltas(records, name, added, deleted, sign))

    def add(batch: DataFrame, number: int) -> None:
        summed(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return deltas.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def kept_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger that keep_ledger keeps under path."""
    return summed(spark.read.parquet(path).drop("batch"))


def compact_ledger(spark: SparkSession, path: str, to: str) -> None:
    """Writes the ledger kept under path as one part of a new ledger; to be called between two runs, the next of which goes on there."""
    kept_ledger(spark, path).write.mode("errorifexists").parquet(f"{to}/batch=-1")
