"""Partitions sorted by key, and scans that skip the row groups a batch cannot touch.

Parquet keeps the least and largest value of a column for every row group.
Where rows are sorted by key inside a partition these ranges are narrow, so a
few key ranges of a batch, given as a plain filter, let Spark's scan pass over
whole row groups.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_clustered(
    df: DataFrame, path: str, partition_by: str, keys: Sequence[str], row_group: int | None = None, mode: str = "errorifexists"
) -> None:
    """Write partitions whose files do not overlap in key, each sorted by key.

    Rows are dealt by range of (partition, key), so a heavy partition is spread
    over several files and tasks.  ``row_group`` is the size in bytes at which
    a row group ends.
    """
    order = [partition_by, *keys]
    writer = df.repartitionByRange(*order).sortWithinPartitions(*order).write.partitionBy(partition_by).mode(mode)
    if row_group is not None:
        writer = writer.option("parquet.block.size", row_group)
    writer.parquet(path)


def key_ranges(batch: DataFrame, key: str, most: int = 32) -> list[tuple]:
    """About ``most`` closed ranges that hold every key of a batch, no two of them overlapping.

    Numeric keys are cut at approximate quantiles and halfway between these, so
    that a wide gap between keys falls between two ranges; other keys make one
    range.  One row per range reaches the driver.
    """
    keys = batch.select(F.col(key).alias("k")).filter("k is not null")
    if batch.schema[key].dataType.typeName() in ("integer", "long", "short", "byte", "double", "float"):
        shares = [n / (most // 2) for n in range(most // 2 + 1)]
        cuts = sorted(set(keys.agg(F.percentile_approx("k", shares).alias("cuts")).first()["cuts"] or []))
        cuts = sorted({*cuts, *((a + b) / 2 for a, b in zip(cuts, cuts[1:]))})
        steps = [F.when(F.col("k") > cut, 1).otherwise(0) for cut in cuts]
        part: Column = reduce(lambda a, b: a + b, steps, F.lit(0))
    else:
        part = F.lit(0)
    found = keys.groupBy(part.alias("part")).agg(F.min("k").alias("low"), F.max("k").alias("high")).collect()
    return sorted((row["low"], row["high"]) for row in found)


def near_keys(base: DataFrame, batch: DataFrame, key: str, most: int = 32) -> DataFrame:
    """The rows of a base that can match a batch on ``key``, and others in the same ranges.

    Only row groups whose range meets one of the batch's are read.  Join the
    result; a row left out has no partner.
    """
    ranges = key_ranges(batch, key, most)
    if not ranges:
        return base.filter(F.lit(False))
    return base.filter(reduce(or_, [F.col(key).between(F.lit(low), F.lit(high)) for low, high in ranges]))
