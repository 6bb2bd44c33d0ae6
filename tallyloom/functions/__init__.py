"""Column expressions. All are built-in functions, so they stay inside generated code."""

from .dates import (
    at_midnight,
    iso_date,
    minus_days,
    minus_months,
    month_index,
    month_number,
    month_start,
    to_day,
)
from .kpi import aov_segment, frequency_segment, retention, revenue_segment
from .values import (
    bucket,
    case,
    concat_key,
    first_known,
    growth_pct,
    is_null,
    mean,
    null_if_zero,
    pct,
    round2,
)

__all__ = [
    "aov_segment",
    "at_midnight",
    "bucket",
    "case",
    "concat_key",
    "first_known",
    "frequency_segment",
    "growth_pct",
    "is_null",
    "iso_date",
    "mean",
    "minus_days",
    "minus_months",
    "month_index",
    "month_number",
    "month_start",
    "null_if_zero",
    "pct",
    "retention",
    "revenue_segment",
    "round2",
    "to_day",
]
