from millrace.functions.columns import (
    date_of,
    days_between,
    parse_date,
    stamp,
    threshold_label,
    weighted_score,
)

__all__ = [
    "date_of",
    "days_between",
    "parse_date",
    "stamp",
    "threshold_label",
    "weighted_score",
]
