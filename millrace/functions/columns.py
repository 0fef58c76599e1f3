"""Column functions, all built from Spark's own expressions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

US_DATE = "M/d/yyyy"


def parse_date(column: str | Column, fmt: str = US_DATE) -> Column:
    """Text to date; text that does not fit the format becomes null."""
    return F.try_to_date(column, fmt)


def date_of(value: str | dt.date) -> dt.date:
    """A batch date given as a date or as ISO text."""
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def stamp(value: str | dt.date) -> Column:
    """A batch date as a literal ISO text column."""
    return F.lit(date_of(value).isoformat())


def days_between(start: str | Column, end: str | Column) -> Column:
    """Whole days from ``start`` to ``end``, as int."""
    return F.datediff(end, start)


def weighted_score(
    weights: Mapping[str, str], scale: int = 2, via: T.DecimalType | None = None
) -> Column:
    """``round(sum(column * weight), scale)`` as double.

    Weights are decimal text, such as ``"0.2"``.  By default the sum runs in
    doubles; with ``via`` each column is cast to that decimal type first, which
    makes the half-up rounding exact.
    """
    if via is None:
        terms = [F.col(name) * F.lit(float(weight)) for name, weight in weights.items()]
    else:
        terms = [
            F.col(name).cast(via) * F.expr(f"{weight}BD") for name, weight in weights.items()
        ]
    return F.round(reduce(add, terms), scale).cast("double")


def threshold_label(value: str | Column, limit: float, within: str, beyond: str) -> Column:
    """``within`` up to and including the limit, else ``beyond`` (nulls too)."""
    column = F.col(value) if isinstance(value, str) else value
    return F.when(column <= F.lit(limit), within).otherwise(beyond)

