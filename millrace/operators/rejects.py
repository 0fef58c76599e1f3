"""The life of a reject: it waits for a correction, and leaves once it passes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.merge import same_key

_FIX = "_fix_"


def corrected(rejects: DataFrame, corrections: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rejects with what corrections bring for their keys; a null corrects nothing.

    Corrections must be unique on ``keys``; those for other rows are ignored.
    """
    columns = [c for c in corrections.columns if c in rejects.columns and c not in keys]
    renamed = corrections.select(*[F.col(c).alias(_FIX + c) for c in (*keys, *columns)])
    met = rejects.join(renamed, same_key(keys, [_FIX + k for k in keys]), "left_outer")
    return met.select(*[F.coalesce(F.col(_FIX + c), F.col(c)).alias(c) if c in columns else F.col(c) for c in rejects.columns])


def replay(rejects: DataFrame, corrections: DataFrame, keys: Sequence[str], rule: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that now pass the rule, and those that go on waiting with what they have been given.

    A rule that is unknown for a row counts as failed.
    """
    now, passes = corrected(rejects, corrections, keys), F.coalesce(rule, F.lit(False))
    return now.filter(passes), now.filter(~passes)


def settle(rejects: DataFrame, entered: DataFrame, keys: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """Rejects without those whose key has entered; with ``within`` only rejects of that batch leave."""
    on = [*keys, *within]
    return rejects.join(entered.select(*on).distinct(), on, "left_anti").select(*rejects.columns)
