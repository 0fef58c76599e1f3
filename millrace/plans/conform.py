"""Raw rows to conformed rows: null policy, dates, consistency, metrics.

The order is part of the meaning: defaults go in before dates are parsed, and
both before the consistency rule.  An open end date thus becomes the default
date and passes the rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import days_between, parse_date, threshold_label, weighted_score
from millrace.operators import quality
from millrace.operators.dedup import dedup_rows
from millrace.plans.specs import ConformSpec

REASON = "Reason"
MISSING = "missing critical value"
INCONSISTENT = "dates missing or out of order"


def with_dates(df: DataFrame, spec: ConformSpec) -> DataFrame:
    """Both date columns parsed in place."""
    return df.withColumns(
        {c: parse_date(F.col(c), spec.date_format) for c in (spec.start, spec.end)}
    )


def derive_metrics(df: DataFrame, spec: ConformSpec) -> DataFrame:
    """Days, score and label, written over whatever the input had there."""
    days = days_between(spec.start, spec.end)
    return df.withColumns(
        {
            spec.days: days,
            spec.score: weighted_score(spec.weights, via=spec.exact_score),
            spec.label: threshold_label(
                days, spec.label_limit, spec.label_within, spec.label_beyond
            ),
        }
    )


def reject_reason(spec: ConformSpec) -> Column:
    """Why a raw row will not make it; null for rows that will."""
    default_end = F.lit(spec.defaults.get(spec.end)).cast("string")
    start = parse_date(F.col(spec.start), spec.date_format)
    end = parse_date(F.coalesce(F.col(spec.end), default_end), spec.date_format)
    return F.when(quality.is_missing(spec.critical), MISSING).when(
        ~F.coalesce(end >= start, F.lit(False)), INCONSISTENT
    )


def conform(df: DataFrame, spec: ConformSpec, unique: bool = False) -> DataFrame:
    """The rows that pass, conformed.

    Repeated rows count once.  Input that is known to be unique, such as rows
    of a merged table, goes through without a shuffle.
    """
    rows = df if unique else dedup_rows(df)
    rows = quality.drop_missing(rows, spec.critical)
    rows = quality.fill_defaults(rows, spec.defaults)
    rows = with_dates(rows, spec)
    rows = quality.keep_consistent(rows, quality.in_order(spec.start, spec.end))
    rows = derive_metrics(rows, spec)
    return quality.enforce_not_null(rows, spec.mandatory)


def audit(df: DataFrame, spec: ConformSpec) -> DataFrame:
    """Counts of raw rows by fate, as one row from one pass."""
    reason = reject_reason(spec)
    return quality.audit(
        df,
        {
            "n_kept": reason.isNull(),
            "n_missing": reason == MISSING,
            "n_inconsistent": reason == INCONSISTENT,
        },
    )


def rejects(df: DataFrame, spec: ConformSpec, unique: bool = False) -> DataFrame:
    """The rows that do not pass, as they came, with the reason."""
    rows = df.withColumn(REASON, reject_reason(spec)).filter(F.col(REASON).isNotNull())
    return rows if unique else dedup_rows(rows)
