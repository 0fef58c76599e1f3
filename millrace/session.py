"""Session helpers: the settings the engine counts on, and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from millrace.sources import files

# Settings the plans lean on.  Small sides are broadcast only under Spark's own
# size check, and skew is dealt with at run time.  All are Spark's defaults but
# the third, which lets a skewed join be split even if an operator above it
# then needs a shuffle of its own.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply ``RECOMMENDED`` to a session."""
    for key, value in RECOMMENDED.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it then gets a temporary
    folder.  On a cluster a machine-local folder would lose data, so a missing
    setting is an error there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path of its own below the shared folder."""
    return f"{shared_dir(spark)}/millrace/{name}-{uuid.uuid4().hex}"


@contextmanager
def staged(df: DataFrame, name: str = "stage") -> Iterator[DataFrame]:
    """Write a frame once to shared storage and hand back the written copy.

    For a frame that several branches of a plan read.  Unlike a cache the copy
    survives lost executors; unlike a checkpoint it is Parquet, so each branch
    reads only its columns and Spark knows the exact size when it decides on a
    broadcast.  The copy is removed at the end of the block.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        files.delete(spark, path)


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate, exact for an unfiltered file scan."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def held_bytes(df: DataFrame) -> int:
    """About what the rows of a file scan take in memory; their number is read from the files' footers.

    Files tell little of that: columns that repeat, or hold few values, nearly
    vanish when they are compressed.
    """
    return df.count() * (df._jdf.schema().defaultSize() + 8 * len(df.columns))


def fits_broadcast(df: DataFrame) -> bool:
    """Whether a file scan is small enough to be a broadcast join side, in its files and in memory."""
    limit = broadcast_limit(df.sparkSession)
    return estimated_bytes(df) <= limit and held_bytes(df) <= limit


def broadcast_limit(spark: SparkSession) -> int:
    """Bytes up to which Spark may broadcast a join side (-1 when it may not)."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text) \
        if not text.startswith("-") else -1
