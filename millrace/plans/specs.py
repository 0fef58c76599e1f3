"""Plain-data descriptions of a table's refinement."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def schema_of(text: str) -> T.StructType:
    """A flat schema from ``"name type, name type"``, without a running session."""
    pairs = [column.split() for column in text.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


@dataclass(frozen=True)
class ConformSpec:
    """How raw text rows become conformed rows.

    ``start`` and ``end`` are date columns held as text in ``date_format``.
    """

    critical: tuple[str, ...]
    defaults: Mapping[str, object]
    start: str
    end: str
    date_format: str
    days: str
    score: str
    weights: Mapping[str, str]
    label: str
    label_limit: float
    label_within: str
    label_beyond: str
    mandatory: tuple[str, ...] = ()
    exact_score: T.DecimalType | None = None


@dataclass(frozen=True)
class TableSpec:
    """A dimension or fact table cut out of wider rows."""

    name: str
    keys: tuple[str, ...]
    schema: T.StructType
    first_wins: tuple[str, ...] = ()
    newest_by: tuple[str, ...] = ()
    partition_by: str | None = None


@dataclass(frozen=True)
class StarSpec:
    dimensions: tuple[TableSpec, ...]
    fact: TableSpec
