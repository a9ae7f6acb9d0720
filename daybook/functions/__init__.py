from daybook.functions.numeric import ceil_mean, nan_to_null
from daybook.functions.text import fixed, grouped
from daybook.functions.time import (
    date_parts,
    epoch_seconds,
    hour_of_day,
    hour_utc,
    months_between_range,
    with_date_parts,
    year_equals,
    year_range,
)

__all__ = [
    "ceil_mean",
    "date_parts",
    "epoch_seconds",
    "fixed",
    "grouped",
    "hour_of_day",
    "hour_utc",
    "months_between_range",
    "nan_to_null",
    "with_date_parts",
    "year_equals",
    "year_range",
]
