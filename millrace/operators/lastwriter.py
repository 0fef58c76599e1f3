"""The last writer of each column, so that batches may arrive in any order.

A row carries a struct with, for each column, the rank of the batch that wrote
its value (null where there is no value).  Of two values the one with the
higher rank stays, of equal ranks the larger value.  That rule is commutative
and associative and takes the same row twice without harm, so late, repeated
and reordered batches end in one result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RANKS = "Column_Ranks"


def ranks_type(columns: Sequence[str], kind: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(c, kind) for c in columns])


def ranked(df: DataFrame, columns: Sequence[str], rank: Column, into: str = RANKS) -> DataFrame:
    """Add the rank of each of the columns: that of the row, where the column has a value."""
    return df.withColumn(into, F.struct(*[F.when(F.col(c).isNotNull(), rank).alias(c) for c in columns]))


def fold(df: DataFrame, keys: Sequence[str], ranks: str = RANKS) -> DataFrame:
    """One row per key: of each ranked column the value of the last writer, with its rank.

    A plain aggregate that combines on the map side, so a key with many rows
    sends one per map task.  Columns without a rank are left out.
    """
    columns = df.schema[ranks].dataType.names
    last = {c: F.max(F.when(F.col(c).isNotNull(), F.struct(F.col(f"{ranks}.{c}").alias("rank"), F.col(c).alias("value")))) for c in columns}
    folded = df.groupBy(*keys).agg(*[last[c].alias(c) for c in columns])
    return folded.select(
        *keys, *[F.col(f"{c}.value").alias(c) for c in columns],
        F.struct(*[F.col(f"{c}.rank").alias(c) for c in columns]).alias(ranks))


def writes(column: str, ranks: str, prefix: str) -> str:
    """SQL for whether the prefixed value replaces the stored one."""
    old, new = f"`{column}`", f"`{prefix}{column}`"
    old_rank, new_rank = f"`{ranks}`.`{column}`", f"`{prefix}{ranks}`.`{column}`"
    later = f"{new_rank} > {old_rank} or ({new_rank} is not null and {old_rank} is null)"
    return f"{new} is not null and ({old} is null or coalesce({later}, false) or ({new_rank} <=> {old_rank} and {new} > {old}))"
