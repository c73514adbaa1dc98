"""Cutting lineage in the folder that all executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most rows of a side that is broadcast: one for each sample and the like, some tens of bytes each.
SMALL = 100_000


def cut(df: DataFrame) -> DataFrame:
    """Writes df to the shared checkpoint folder and goes on from there.

    The folder is the one the cluster names in spark.checkpoint.dir; only where
    that is unset, as in local tests, a temporary one is made.  Files on shared
    storage outlive lost executors, unlike local checkpoints.  Spark removes
    those of a frame that is no longer used if
    spark.cleaner.referenceTracking.cleanCheckpoints is set, which the session
    has to be started with.
    """
    ready(df.sparkSession)
    return df.checkpoint(eager=True)


def small_side(df: DataFrame) -> DataFrame:
    """df, cut, to be broadcast in a join if it has at most SMALL rows; a larger one is joined by a shuffle."""
    written = cut(df)
    return F.broadcast(written) if written.limit(SMALL + 1).count() <= SMALL else written


def ready(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None and not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share; a temporary one of this machine is no use on a cluster")
    context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-checkpoint-"))
