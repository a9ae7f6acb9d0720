from daybook.operators.activity import (
    distinct_count,
    distinct_stats,
    distinct_values,
    group_counts,
    hourly_counts,
    peak_hours,
    top_groups,
)
from daybook.operators.basic import even_double, first_value, row_count, sequence, sort_small, sql_count
from daybook.operators.daily import (
    DAY_KEYS,
    SUMMARY_COLUMNS,
    TripColumns,
    daily_overview,
    daily_summary,
    month_counts,
    newest_days,
    select_period,
)
from daybook.operators.percentile import exact_percentile

__all__ = [
    "DAY_KEYS",
    "SUMMARY_COLUMNS",
    "TripColumns",
    "daily_overview",
    "daily_summary",
    "distinct_count",
    "distinct_stats",
    "distinct_values",
    "even_double",
    "exact_percentile",
    "first_value",
    "group_counts",
    "hourly_counts",
    "month_counts",
    "newest_days",
    "peak_hours",
    "row_count",
    "select_period",
    "sequence",
    "sort_small",
    "sql_count",
    "top_groups",
]
