"""Daily summaries: one row per calendar day with six metrics.

Plan shape (checked with ``explain``): scan with the year range pushed into
the parquet reader and only the six used columns in ``ReadSchema`` ->
partial aggregate per task (map-side combine, one buffer per day) -> hash
exchange on the three day keys -> final aggregate. At most 366 keys per year,
so the shuffle carries ``tasks x days`` small buffers no matter how many rows
are read, and a hot day is already pre-aggregated before it is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.numeric import ceil_mean, nan_to_null
from daybook.functions.time import date_parts, months_between_range, year_range
from daybook.operators.basic import sort_small
from daybook.operators.percentile import band, exact_percentile, join_null_safe
from daybook.session import ensure_checkpoint_dir

DAY_KEYS = ("dt_year", "dt_month", "dt_day")

# The daily summary's output column names, in output order.
SUMMARY_COLUMNS = (
    "dt_year",
    "dt_month",
    "dt_day",
    "num_trips",
    "mean_trip_distance",
    "max_mta_tax",
    "q95_fare_amount",
    "min_tip_amount",
    "mean_passenger_count",
)


@dataclass(frozen=True)
class TripColumns:
    """Input column names; defaults are the taxi table's."""

    ts: str = "tpep_pickup_datetime"
    distance: str = "trip_distance"
    tax: str = "mta_tax"
    fare: str = "fare_amount"
    tip: str = "tip_amount"
    passengers: str = "passenger_count"


def select_period(
    df: DataFrame,
    ts: str,
    year: int | None = None,
    months: tuple[int, int] | None = None,
) -> DataFrame:
    """Keep one calendar year, optionally a month span ``(first, last)`` of it.

    Both filters are timestamp ranges, so they reach the scan as pushed
    filters (and as partition filters when the data is laid out by date).
    """
    if months is not None and year is None:
        raise ValueError("a month span needs a year")
    if months is not None:
        return df.where(months_between_range(df, ts, year, *months))
    if year is not None:
        return df.where(year_range(df, ts, year))
    return df


def daily_summary(
    df: DataFrame,
    cols: TripColumns = TripColumns(),
    year: int | None = None,
    months: tuple[int, int] | None = None,
    quantile: float = 0.95,
    accuracy: int = 10000,
    exact: bool = False,
    mean_digits: int | None = None,
    nan_as_null: bool = True,
    ordered: bool = True,
) -> DataFrame:
    """Group by day and compute the six metrics.

    * ``num_trips``: ``count(*)``;
    * ``mean_trip_distance``: mean, optionally rounded to ``mean_digits``;
    * ``max_mta_tax`` / ``min_tip_amount``: extremes (NaN sorts highest);
    * ``q95_fare_amount``: ``quantile`` percentile, approximate with
      ``accuracy`` (bounded memory per group); ``exact=True`` gives the
      discrete percentile through a distributed sort (no group is gathered
      into one task);
    * ``mean_passenger_count``: mean rounded up (BIGINT). NaN is read as
      NULL first unless ``nan_as_null=False`` (raw Spark gives 0 for NaN).

    Rows are newest day first when ``ordered`` (see ``newest_first``).
    """
    passengers = nan_to_null(df, cols.passengers) if nan_as_null else F.col(cols.passengers)
    parts = date_parts(cols.ts)
    src = select_period(df, cols.ts, year, months).select(
        *[expr.alias(name) for name, expr in parts.items()],
        F.col(cols.distance).alias("_distance"),
        F.col(cols.tax).alias("_tax"),
        F.col(cols.fare).alias("_fare"),
        F.col(cols.tip).alias("_tip"),
        passengers.alias("_passengers"),
    )

    mean: Column = F.avg("_distance")
    if mean_digits is not None:
        mean = F.round(mean, mean_digits)
    metrics = [
        F.count(F.lit(1)).alias("num_trips"),
        mean.alias("mean_trip_distance"),
        F.max("_tax").alias("max_mta_tax"),
    ]
    if not exact:
        metrics.append(F.percentile_approx("_fare", quantile, accuracy).alias("q95_fare_amount"))
    metrics += [
        F.min("_tip").alias("min_tip_amount"),
        ceil_mean(F.col("_passengers")).alias("mean_passenger_count"),
    ]
    if not exact:
        out = src.groupBy(*DAY_KEYS).agg(*metrics)
    else:
        # The aggregate also counts the fares and reads their band off a sketch
        # per day (one row per day, checkpointed), so the exact percentile
        # needs one further read of the input (two if a band misses).
        ensure_checkpoint_dir(df.sparkSession)
        counted = src.groupBy(*DAY_KEYS).agg(*metrics, *band("_fare", quantile, accuracy)).checkpoint()
        bands = counted.select(*DAY_KEYS, "_n", "_lo", "_hi")
        q = exact_percentile(src, list(DAY_KEYS), "_fare", quantile, "q95_fare_amount", accuracy, bands=bands)
        # NULL-safe: rows without a pickup time are a day of their own.
        out = join_null_safe(counted, q, list(DAY_KEYS), "left").select(*SUMMARY_COLUMNS)
    return newest_first(out) if ordered else out


def newest_first(daily: DataFrame) -> DataFrame:
    """Sort a daily result newest day first, in one partition.

    The result holds at most one row per calendar day (366 per year), so one
    partition holds it. A global ``orderBy`` would first sample its input
    for range bounds, and that sample job runs the final aggregation (the
    merge of every task's percentile sketches) a second time; moving the
    finished rows into one partition and sorting there runs it once.
    """
    return sort_small(daily, *[F.col(k).desc() for k in DAY_KEYS])


def newest_days(daily: DataFrame, n: int = 20) -> DataFrame:
    """First ``n`` days, newest first: ``TakeOrderedAndProject`` (top-k, no full sort)."""
    return daily.orderBy(*[F.col(k).desc() for k in DAY_KEYS]).limit(n)


def daily_overview(daily: DataFrame) -> DataFrame:
    """One row over a daily summary: totals and the covered dates.

    ``avg_daily_trips`` is rounded half to even, as the reference's printed
    mean is. ``first_day``/``last_day`` are the real first and last day.
    ``component_range`` repeats the reference's printed range, which takes
    min/max of month and of day separately (so it need not be a real day).
    """
    day = F.make_date("dt_year", "dt_month", "dt_day")
    n = F.count(F.lit(1))
    component = F.format_string(
        "%02d/%02d/%d to %02d/%02d/%d",
        F.min("dt_month"),
        F.min("dt_day"),
        F.max("dt_year"),
        F.max("dt_month"),
        F.max("dt_day"),
        F.max("dt_year"),
    )
    return daily.agg(
        F.coalesce(F.sum("num_trips"), F.lit(0)).cast("bigint").alias("total_trips"),
        n.alias("total_days"),
        F.bround(F.avg("num_trips"), 0).alias("avg_daily_trips"),
        F.min(day).alias("first_day"),
        F.max(day).alias("last_day"),
        F.when(n > 0, component).alias("component_range"),
    )


def month_counts(df: DataFrame, ts: str, year: int, months: tuple[int, int]) -> DataFrame:
    """Rows per month for a month span of one year (the month-subset load)."""
    src = select_period(df, ts, year, months)
    return src.groupBy(F.month(ts).alias("dt_month")).agg(F.count(F.lit(1)).alias("num_trips"))
