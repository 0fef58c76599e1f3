"""Null policy, consistency rules, rejects and audit counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_missing(columns: Sequence[str]) -> Column:
    """True where any of the columns is null."""
    return reduce(or_, [F.col(c).isNull() for c in columns])


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows in which any of the columns is null."""
    return df.na.drop(how="any", subset=list(columns))


def split_missing(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with all of the columns set, and the rest."""
    return df.filter(~is_missing(columns)), df.filter(is_missing(columns))


def check_policy(schema: T.StructType, defaults: Mapping[str, object]) -> None:
    """Fail early when a default cannot stand in its column."""
    for name, value in defaults.items():
        if name not in schema.names:
            raise ValueError(f"default for unknown column {name!r}")
        kind = schema[name].dataType
        if isinstance(value, bool):
            fits = isinstance(kind, T.BooleanType)
        elif isinstance(value, str):
            fits = isinstance(kind, T.StringType)
        elif isinstance(value, int):
            fits = isinstance(kind, T.NumericType)
        else:
            fits = isinstance(value, float) and isinstance(kind, T.FractionalType)
        if not fits:
            raise ValueError(f"default {value!r} does not fit column {name!r} ({kind.simpleString()})")


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace nulls column by column."""
    check_policy(df.schema, defaults)
    return df.na.fill(dict(defaults))


def in_order(start: str, end: str) -> Column:
    """Whether ``end`` is not before ``start``; unknown when either is null."""
    return F.col(end) >= F.col(start)


def keep_consistent(df: DataFrame, rule: Column) -> DataFrame:
    """Rows for which the rule holds."""
    return df.filter(rule)


def reject_inconsistent(df: DataFrame, rule: Column) -> DataFrame:
    """The complement of ``keep_consistent``: the rule fails or is unknown."""
    return df.filter(~F.coalesce(rule, F.lit(False)))


def enforce_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Make a null in a mandatory column an error when the row is computed."""
    return df.withColumns(
        {
            c: F.coalesce(
                F.col(c),
                F.raise_error(F.lit(f"null in mandatory column {c}")).cast(df.schema[c].dataType),
            )
            for c in columns
        }
    )


def audit(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row: the row count, and per rule the number of rows it holds for."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), *_counts(rules))


def observed(
    df: DataFrame, rules: Mapping[str, Column], name: str | None = None
) -> tuple[DataFrame, Observation]:
    """The same counts, gathered while another action runs over the frame."""
    watch = Observation(name) if name else Observation()
    return df.observe(watch, F.count(F.lit(1)).alias("n_rows"), *_counts(rules)), watch


def _counts(rules: Mapping[str, Column]) -> list[Column]:
    return [F.count_if(rule).alias(name) for name, rule in rules.items()]
