from tallyframe.functions.scalar import (
    compact_date,
    date_part,
    is_numeric,
    numeric_or_empty,
    ratio_status,
    report_key,
    safe_ratio,
    split_report_key,
    window_start,
)

__all__ = [
    "compact_date",
    "date_part",
    "is_numeric",
    "numeric_or_empty",
    "ratio_status",
    "report_key",
    "safe_ratio",
    "split_report_key",
    "window_start",
]
