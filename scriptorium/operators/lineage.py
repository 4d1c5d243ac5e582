"""Cutting the lineage of intermediate results."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame

#: Tasks that a spread gives each core.
WAVES = 3


def cut(df: DataFrame) -> DataFrame:
    """The same rows with their lineage cut by a reliable checkpoint.

    The folder is the one the session names in spark.checkpoint.dir, which all
    executors share.  Where none is set, only a session on one machine may go on,
    with a folder of that machine; a cluster gets an error.
    """
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_folder(df.sparkSession, "scriptorium-checkpoints"))
    return df.checkpoint(eager=True)


def shared_folder(spark, name: str) -> str:  # noqa: ANN001
    """The folder for intermediate results: that of spark.checkpoint.dir, else one of this machine if all tasks run on it."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    if sc.master != "local" and not sc.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return os.path.join(tempfile.gettempdir(), name)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """The same rows over enough partitions to keep every core busy with work that costs much more than moving them.

    Input of few or large files would leave cores idle in a Python stage; it is
    dealt out by a hash of unique keys.  Input that by its size comes in at least
    two partitions a core is left where it is, so no shuffle grows with it.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= 2 * cores * _bytes(spark):
        return df
    return df.repartition(max(WAVES * cores, int(spark.conf.get("spark.sql.shuffle.partitions"))), *keys)


def _bytes(spark) -> int:  # noqa: ANN001
    """Bytes of a read partition."""
    return int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
