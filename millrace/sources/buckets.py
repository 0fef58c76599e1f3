"""Tables laid out by a hash of their key, for merges that move no stored row.

A table is written with ``bucketBy`` and ``sortBy``, and the number of the bucket
is a partition column too.  A batch knows from its own keys which buckets it
touches; only these are read, joined where they lie (the batch alone is
shuffled) and written again by dynamic partition overwrite.  Nothing scans the
keys of the history, and untouched buckets are not rewritten.

Spark's own writer replaces a bucket folder after the job has written its new
files elsewhere.  A driver that dies while folders are being swapped can leave
a bucket half swapped; keep dated history in ``tables.Table``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.dedup import require_unique
from millrace.operators.merge import aligned, merge
from millrace.session import staged
from millrace.sources import files

SLOT = "_bucket"


class BucketedTable:
    """A table with a declared schema and key, in a fixed number of buckets.

    ``name`` is its entry in the session's catalog; where that is new, the
    folders below ``path`` are taken as they are.  ``buckets`` should be no
    less than the shuffle partitions of the session, or Spark prefers to
    shuffle both sides, and large enough for a bucket to fit a task.
    """

    def __init__(self, spark: SparkSession, name: str, path: str, schema: T.StructType, keys: Sequence[str], buckets: int = 64):
        if SLOT in schema.names:
            raise ValueError(f"column name {SLOT} is taken")
        self.spark, self.name, self.path = spark, name, path.rstrip("/")
        self.schema, self.keys, self.buckets = schema, list(keys), buckets

    def _slot(self) -> Column:
        """The bucket of a row, by the hash that ``bucketBy`` uses."""
        return F.pmod(F.hash(*self.keys), F.lit(self.buckets)).alias(SLOT)

    def _opened(self) -> bool:
        if self.spark.catalog.tableExists(self.name):
            return True
        if not files.exists(self.spark, self.path):
            return False
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
        keys = ", ".join(f"`{k}`" for k in self.keys)
        self.spark.sql(
            f"create table {self.name} ({columns}, `{SLOT}` int) using parquet partitioned by (`{SLOT}`) "
            f"clustered by ({keys}) sorted by ({keys}) into {self.buckets} buckets location '{self.path}'")
        self.spark.catalog.recoverPartitions(self.name)
        return True

    def read(self) -> DataFrame:
        """All rows; an empty frame before the first write."""
        if not self._opened():
            return self.spark.createDataFrame([], self.schema)
        return self.spark.table(self.name).select(*self.schema.names)

    def merge(
        self,
        incoming: DataFrame,
        first_wins: Sequence[str] = (),
        null_policy: str = "keep_old",
        ranks: str | None = None,
    ) -> list[int]:
        """Upsert a batch as ``operators.merge.merge`` does; returns the buckets that were written.

        A batch with a doubled key, or a row without one, raises and changes nothing.
        """
        with staged(aligned(incoming, self.schema)) as batch:
            require_unique(batch, self.keys)
            touched = sorted(row[0] for row in batch.select(self._slot()).distinct().collect())
            if not touched:
                return []
            if not self._opened():
                self._create(batch)
            else:
                self._replace(merge(self._stored(touched), batch, self.keys, first_wins, null_policy, "full_outer", ranks=ranks))
        return touched

    def _stored(self, touched: Sequence[int]) -> DataFrame:
        """The rows of some buckets, still known to Spark as bucketed."""
        return self.spark.table(self.name).filter(F.col(SLOT).isin(list(touched))).select(*self.schema.names)

    def _create(self, rows: DataFrame) -> None:
        dealt = rows.repartition(self.buckets, *self.keys).select(*self.schema.names, self._slot())
        writer = dealt.write.partitionBy(SLOT).bucketBy(self.buckets, *self.keys).sortBy(*self.keys)
        writer.option("path", self.path).saveAsTable(self.name)

    def _replace(self, rows: DataFrame) -> None:
        with _dynamic(self.spark):
            rows.select(*self.schema.names, self._slot()).write.insertInto(self.name, overwrite=True)


@contextmanager
def _dynamic(spark: SparkSession) -> Iterator[None]:
    """Overwrites replace only the partitions they have rows for."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)
