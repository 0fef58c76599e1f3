"""Incremental drops with Structured Streaming.

A checkpoint remembers which files were read, so each file is taken once, a
failed micro-batch is taken again, and files that arrive late are taken by the
next run.  The tables record the micro-batch number in the commit of the data,
so a micro-batch that is replayed after a crash is not applied twice.  Numbers
are kept by the query id that Spark stores in the checkpoint: streams with
checkpoints of their own may feed one table, and a rebuilt checkpoint counts
as a new stream, which reads its files again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import date_of
from millrace.operators.dedup import dedup_by_key
from millrace.operators.quality import split_missing
from millrace.plans import lms
from millrace.plans.landing import Date, land_new, rejects_of
from millrace.sources import csv
from millrace.session import staged
from millrace.sources.tables import Origin, Table

Handler = Callable[[DataFrame, int], None]


def run_available(stream: DataFrame, handler: Handler, checkpoint: str) -> None:
    """Hand everything that is waiting to ``handler``, then stop.  Errors are raised."""
    query = (
        stream.writeStream.foreachBatch(handler)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def stream_id(df: DataFrame) -> str:
    """Id of the stream a micro-batch belongs to, the same across restarts from one checkpoint."""
    found = df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not found:
        raise RuntimeError("not a micro-batch of a running stream")
    return found


def landing_into(
    table: Table,
    batch_date: Date,
    schema: T.StructType = lms.EXTRACT,
    min_rows: int = 1,
    check_header: bool = True,
) -> Handler:
    """Land the files that a micro-batch of names lists, as ``landing.ingest`` does.

    The manifest knows the files that are in, so a micro-batch taken again
    lands nothing twice, and a file that cannot be read does not stop the stream.
    """
    day = date_of(batch_date).isoformat()

    def handle(df: DataFrame, number: int) -> None:
        land_new(df, table, day, schema, min_rows, check_header)

    return handle


def merging_into(
    table: Table,
    keys: Sequence[str],
    order_by: Sequence[Column] = (),
    first_wins: Sequence[str] = (),
) -> Handler:
    """Upsert each micro-batch into a table, one row per key.

    ``order_by`` picks the survivor among rows of one key; columns the table
    does not have may be used for that and are dropped afterwards.  Rows
    without a key go to ``rejects_of(table)``, as JSON.
    """

    def handle(df: DataFrame, number: int) -> None:
        origin = Origin(stream=(stream_id(df), number))
        with staged(df, "micro-batch") as batch:
            keyed, unkeyed = split_missing(batch, keys)
            if not unkeyed.isEmpty():
                source = F.col(csv.SOURCE_FILE) if csv.SOURCE_FILE in df.columns else F.lit(None).cast("string")
                rejects_of(table).append(
                    unkeyed.select(
                        source.alias(csv.SOURCE_FILE),
                        F.to_json(F.struct("*")).alias("Line"),
                        F.lit("missing key").alias("Reason"),
                        F.lit(None).cast("string").alias(lms.BATCH),
                    ),
                    origin,
                )
            rows = dedup_by_key(keyed, keys, order_by)
            incoming = rows.select(*[c for c in df.columns if c in table.schema.names])
            table.merge(incoming, keys, first_wins, origin=origin, unique=True)

    return handle


def land_available(
    spark: SparkSession,
    directory: str,
    table: Table,
    batch_date: Date,
    checkpoint: str,
    schema: T.StructType = lms.EXTRACT,
    min_rows: int = 1,
    max_files: int | None = None,
    check_header: bool = True,
) -> None:
    """Land every drop of a directory that is new to this checkpoint and to the table's manifest."""
    names = csv.names_stream(spark, directory, max_files)
    run_available(names, landing_into(table, batch_date, schema, min_rows, check_header), checkpoint)
