"""Row counts of every step, gathered in the pass that does the work and kept beside the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources import files

SCHEMA = T.StructType([
    T.StructField("layer", T.StringType()), T.StructField("batch", T.StringType()), T.StructField("n_read", T.LongType()),
    T.StructField("n_kept", T.LongType()), T.StructField("n_rejected", T.LongType()), T.StructField("taken_at", T.TimestampType()),
])


def counted(df: DataFrame, rejected: Column) -> tuple[DataFrame, Observation]:
    """The frame with counts of read, kept and rejected rows that ride on the next action over it."""
    watch = Observation()
    return df.observe(
        watch, F.count(F.lit(1)).alias("n_read"), F.count_if(~rejected).alias("n_kept"), F.count_if(rejected).alias("n_rejected")), watch


class Audits:
    """A Parquet folder with one row per layer, batch and run."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def record(self, layer: str, batch: str, counts: dict[str, int]) -> None:
        """Keep the counts of a step; a step that lost or invented rows raises."""
        read, kept, rejected = (counts[name] for name in ("n_read", "n_kept", "n_rejected"))
        if read != kept + rejected:
            raise RuntimeError(f"{layer} {batch}: read {read} rows, kept {kept} and rejected {rejected}")
        row = self.spark.createDataFrame([(layer, batch, read, kept, rejected)], T.StructType(SCHEMA.fields[:-1]))
        row.withColumn("taken_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(self.path)

    def read(self) -> DataFrame:
        """Every run's counts."""
        if not files.exists(self.spark, self.path):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def latest(self) -> DataFrame:
        """The counts of the last run of each layer and batch."""
        last = F.max(F.struct("taken_at", "n_read", "n_kept", "n_rejected")).alias("last")
        return self.read().groupBy("layer", "batch").agg(last).select("layer", "batch", "last.n_read", "last.n_kept", "last.n_rejected")
