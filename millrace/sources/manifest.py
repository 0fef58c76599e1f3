"""One small row per file: what became of it, so that no file is read twice.

The manifest is a Parquet folder that only grows, written by Spark's own
writer.  A file is claimed before it is read and gets its outcome afterwards;
a claim without an outcome tells that a run died in between.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources import files

CLAIMED, LANDED, SKIPPED, QUARANTINED = "claimed", "landed", "skipped", "quarantined"

SCHEMA = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("modified", T.TimestampType()), T.StructField("state", T.StringType()),
    T.StructField("rows", T.LongType()), T.StructField("reason", T.StringType()), T.StructField("batch", T.StringType()),
])


@dataclass(frozen=True)
class Outcome:
    """What became of one file."""

    path: str
    modified: object
    state: str
    rows: int | None = None
    reason: str | None = None
    batch: str | None = None


class Manifest:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def exists(self) -> bool:
        return files.exists(self.spark, self.path)

    def read(self) -> DataFrame:
        if not self.exists():
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def record(self, outcomes: Iterable[Outcome]) -> None:
        rows = [(o.path, o.modified, o.state, o.rows, o.reason, o.batch) for o in outcomes]
        if rows:
            self.append(self.spark.createDataFrame(rows, SCHEMA).coalesce(1))

    def append(self, df: DataFrame) -> None:
        df.select(*SCHEMA.names).write.mode("append").parquet(self.path)

    def unseen(self, listing: DataFrame) -> DataFrame:
        """Listed files (path, modified) without an outcome.

        A landed name stays landed; a file that was skipped or put in
        quarantine is looked at again once it has changed.  The history is cut
        down to the listed names first.  A short listing is broadcast for
        that; for a longer one Spark's runtime Bloom filter drops other names
        in the scan of the history, before anything is shuffled.
        """
        known = self.read().filter(F.col("state") != CLAIMED).join(listing.select("path"), "path", "left_semi")
        landed = known.filter(F.col("state") == LANDED).select("path")
        looked_at = known.select("path", "modified")
        return listing.join(landed, "path", "left_anti").join(looked_at, ["path", "modified"], "left_anti")

    def unfinished(self, listing: DataFrame) -> DataFrame:
        """Listed files that an earlier run has claimed; those with an outcome are none of them."""
        claims = self.read().filter(F.col("state") == CLAIMED).join(listing.select("path"), "path", "left_semi")
        return self.unseen(listing).join(claims.select("path"), "path", "left_semi")

    def quarantine(self) -> DataFrame:
        """Files that could not be read, with the reason."""
        return self.read().filter(F.col("state") == QUARANTINED).select("path", "modified", "reason", "batch")
