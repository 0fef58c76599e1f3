"""Writes that are read back: an order-free checksum of rows written against rows read."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class Checksum(NamedTuple):
    rows: int
    total: Decimal


def checksum_columns(df: DataFrame) -> list[Column]:
    """Aggregates that do not depend on order or partitions: a count and the wide sum of row hashes.

    Null flags are hashed too, as a null leaves a running hash as it is.
    Repeated rows count each time.
    """
    cells = [F.col(f"`{c}`") for c in df.columns]
    row = F.xxhash64(*cells, *[c.isNull() for c in cells]).cast("decimal(38,0)")
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row), F.lit(0).cast("decimal(38,0)")).alias("total")]


def checksum(df: DataFrame) -> Checksum:
    row = df.agg(*checksum_columns(df)).first()
    return Checksum(row["rows"], row["total"])


def write_checked(df: DataFrame, write: Callable[[DataFrame], None], read: Callable[[], DataFrame]) -> Checksum:
    """Write a frame, read it back and compare; RuntimeError if a row was lost, added or changed.

    What is written is summed up by the writing job itself, so only the
    reading costs a scan.
    """
    watch = Observation()
    write(df.observe(watch, *checksum_columns(df)))
    wrote = Checksum(watch.get["rows"], watch.get["total"])
    found = checksum(read().select(*[f"`{c}`" for c in df.columns]))
    if wrote != found:
        raise RuntimeError(f"wrote {wrote.rows} rows with checksum {wrote.total}, read back {found.rows} with {found.total}")
    return found
