"""Dimension and fact tables out of conformed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.dedup import dedup_by_key
from millrace.operators.merge import merge
from millrace.plans.specs import TableSpec
from millrace.sources.tables import Origin, Table


def rows_for(df: DataFrame, spec: TableSpec, unique_on: Sequence[str] = ()) -> DataFrame:
    """Wide rows cut down to a table's columns and grain.

    Several rows of one key, such as a student's courses, become one: the
    newest by ``spec.newest_by``.  That happens before the merge, so the join
    sees each key once.  Only the columns needed reach the shuffle, and rows
    known to be ``unique_on`` the table's own keys need none.
    """
    order = [c for c in spec.newest_by if c not in spec.schema.names]
    rows = df.select(*spec.schema.names, *order)
    if not unique_on or not set(unique_on) <= set(spec.keys):
        rows = dedup_by_key(rows, spec.keys, [F.col(c).desc_nulls_last() for c in spec.newest_by])
    return rows.selectExpr(
        *[f"cast(`{f.name}` as {f.dataType.simpleString()}) as `{f.name}`" for f in spec.schema]
    )


def build(
    stored: DataFrame,
    df: DataFrame,
    spec: TableSpec,
    strategy: str = "auto",
    unique_on: Sequence[str] = (),
) -> DataFrame:
    """A stored table with the new rows merged in, as a frame."""
    incoming = rows_for(df, spec, unique_on)
    return merge(stored, incoming, spec.keys, spec.first_wins, strategy=strategy)


def merge_into(
    table: Table,
    df: DataFrame,
    spec: TableSpec,
    origin: Origin = Origin(),
    unique_on: Sequence[str] = (),
) -> None:
    """Merge new rows into a stored table."""
    incoming = rows_for(df, spec, unique_on)
    table.merge(incoming, spec.keys, spec.first_wins, origin=origin, unique=True)
