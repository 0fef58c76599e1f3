"""What is new: batches by date, unseen files, pending batches, tiny drops."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import date_of, stamp


def stamp_batch(df: DataFrame, batch_date: str | dt.date, column: str = "Processing_Date") -> DataFrame:
    """Add the batch date as ISO text."""
    return df.withColumn(column, stamp(batch_date))


def batch_of(
    df: DataFrame, batch_date: str | dt.date, column: str | Column = "Processing_Date"
) -> DataFrame:
    """Rows of one batch date.  On a partition column this prunes to one partition."""
    name = F.col(column) if isinstance(column, str) else column
    kind = df.select(name.alias("d")).schema["d"].dataType.typeName()
    if kind in ("timestamp", "timestamp_ntz"):
        # A half-open range instead of a cast, so that the scan can skip row groups.
        day = date_of(batch_date)
        start, end = F.lit(day).cast(kind), F.lit(day + dt.timedelta(days=1)).cast(kind)
        return df.filter((name >= start) & (name < end))
    value = stamp(batch_date) if kind == "string" else F.lit(date_of(batch_date))
    return df.filter(name == value)


def batches_of(df: DataFrame, dates: DataFrame, column: str) -> DataFrame:
    """Rows of a list of batch dates, in one pass.

    ``dates`` is a small table with the same column.  On a partition column its
    dates become a filter at run time (dynamic partition pruning), so only the
    partitions listed are read, without a job per date.  Spark prunes only by
    a side that is filtered itself, so the first and the last date, looked up
    once, go in as a plain range on both sides.
    """
    ends = dates.agg(F.min(column).alias("low"), F.max(column).alias("high")).first()
    if ends["low"] is None:
        return df.filter(F.lit(False))
    within = F.col(column).between(F.lit(ends["low"]), F.lit(ends["high"]))
    wanted = dates.filter(within).select(column).distinct()
    return df.filter(within).join(wanted, column, "left_semi").select(*df.columns)


def unseen(listing: DataFrame, seen: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of a listing whose key has not been seen before, one per key.

    ``seen`` may name a key many times; it is reduced to distinct keys on the
    map side first, so a file with a large share of the rows stays cheap.
    """
    return (
        listing.select(*keys).distinct()
        .join(seen.select(*keys).distinct(), list(keys), "left_anti")
    )


def pending_batches(batches: DataFrame, ledger: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Batches without a ledger row.  The ledger gets its row after success only."""
    return unseen(batches, ledger, keys)


def min_rows_guard(df: DataFrame, group: Sequence[str], min_rows: int = 1) -> DataFrame:
    """Drop the rows of groups (such as source files) with fewer than ``min_rows``.

    A group that has a row has one row, so the default costs nothing.  Else the
    sizes come from a map-side combined count, and the rows meet only the keys
    that fall short.
    """
    if min_rows <= 1:
        return df
    short = df.groupBy(*group).count().filter(F.col("count") < min_rows).select(*group)
    same = [F.col(f"all.{c}").eqNullSafe(F.col(f"short.{c}")) for c in group]
    return df.alias("all").join(short.alias("short"), same, "left_anti").select("all.*")
