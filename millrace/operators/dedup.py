"""Duplicate removal with a survivor that does not depend on row order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup_by_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Column] = ()
) -> DataFrame:
    """Keep one row per key: the first by ``order_by``, then by all other columns.

    Null keys count as equal to each other.  The ordering is total up to rows
    that are equal in every column, so the result is the same for any input
    order.  Spark turns ``row_number() = 1`` into a group limit that runs on
    each input partition before the shuffle, so a key that holds a large share
    of the rows sends at most one row per map task.
    """
    ties = [F.col(c).asc_nulls_last() for c in df.columns if c not in keys]
    ranked = Window.partitionBy(*keys).orderBy(*order_by, *ties or [F.lit(0)])
    return (
        df.withColumn("_rank", F.row_number().over(ranked))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def dedup_rows(df: DataFrame) -> DataFrame:
    """Drop rows that repeat another row in every column."""
    return df.dropDuplicates()


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct()


def has_doubles(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether a key comes more than once; reads the key columns alone and combines on the map side."""
    return not df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_times")).filter("_times > 1").isEmpty()


def require_unique(df: DataFrame, keys: Sequence[str], complete: bool = True) -> None:
    """Raise ValueError if a key comes more than once, or with ``complete`` if a row has none.

    One map-side combined count; a single offending key reaches the driver.
    """
    if not complete:
        df = df.na.drop(how="any", subset=list(keys))
    missing = " or ".join(f"`{k}` is null" for k in keys)
    offending = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_times")).filter(f"_times > 1 or {missing}").limit(1).collect()
    if offending:
        row = offending[0].asDict()
        times = row.pop("_times")
        raise ValueError(f"key {row} comes {times} times in a batch" if times > 1 else f"row without a key: {row}")
