"""Activity analysis over event-like rows: distinct counts, busiest groups, hours.

All of these are single aggregations with partial (map-side) aggregation, so
a hot key is combined inside each task before the shuffle: the shuffle carries
at most one row per key per task, never the raw rows of a hot group.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.time import hour_of_day


def distinct_stats(
    df: DataFrame,
    columns: Mapping[str, str],
    approx: bool = False,
    rsd: float = 0.05,
) -> DataFrame:
    """One row: for each ``alias -> column``, the number of distinct non-NULL values.

    Exact (default) is Catalyst's multi-distinct plan: ``Expand`` tags each
    row once per column, a partial aggregate drops duplicates inside each
    task, and one shuffle carries the remaining distinct values. For a
    near-unique column (a comment id) that still moves every id once;
    ``approx=True`` uses HyperLogLog++ sketches instead (``rsd`` relative
    standard deviation): fixed-size buffers, no values shuffled.
    """
    if not columns:
        raise ValueError("no columns given")
    if approx:
        aggs = [F.approx_count_distinct(c, rsd).alias(a) for a, c in columns.items()]
    else:
        aggs = [F.count_distinct(F.col(c)).alias(a) for a, c in columns.items()]
    return df.agg(*aggs)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The distinct values of one column; NULL is kept as one value."""
    return df.select(column).distinct()


def distinct_count(df: DataFrame, column: str | Column, excl: str = "n_excl", incl: str = "n_incl") -> DataFrame:
    """Both readings of "how many distinct values", in one pass.

    ``excl``: ``count(DISTINCT c)``, NULL not counted.
    ``incl``: ``select(c).distinct().count()``, NULL counted as one value.
    ``incl = excl + (1 if any NULL)``, so a single aggregation gives both
    instead of a second distinct shuffle.
    """
    c = F.col(column) if isinstance(column, str) else column
    has_null = F.coalesce(F.max(F.when(c.isNull(), F.lit(1)).otherwise(F.lit(0))), F.lit(0))
    n = F.count_distinct(c)
    return df.agg(n.alias(excl), (n + has_null).cast("bigint").alias(incl))


def group_counts(df: DataFrame, key: str | Column, count_name: str = "n") -> DataFrame:
    """Rows per value of ``key``."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(count_name))


def top_groups(df: DataFrame, key: str, n: int = 10, count_name: str = "n") -> DataFrame:
    """The ``n`` busiest keys, most rows first; ties go to the smaller key.

    ``orderBy + limit`` plans as ``TakeOrderedAndProject``: each task keeps
    its own top ``n`` and the driver merges ``tasks x n`` rows, no full sort.
    """
    if n <= 0:
        raise ValueError("n must be positive")
    counts = group_counts(df, key, count_name)
    return counts.orderBy(F.col(count_name).desc(), F.col(key).asc_nulls_last()).limit(n)


def hourly_counts(df: DataFrame, column: str, hour_name: str = "hour", count_name: str = "n") -> DataFrame:
    """Rows per hour of day in UTC (at most 25 rows: 24 hours, and NULL for rows without a time).

    ``column`` is epoch seconds (``created_utc``) or a timestamp; the hour is
    computed without the session time zone (see ``hour_utc``).
    """
    return group_counts(df.select(hour_of_day(df, column).alias(hour_name)), hour_name, count_name)


def peak_hours(
    df: DataFrame, column: str, k: int = 1, hour_name: str = "hour", count_name: str = "n"
) -> DataFrame:
    """The ``k`` busiest hours, most rows first; ties go to the earlier hour.

    Rows without a time form a NULL hour; on a tie it ranks after every real hour.
    """
    hours = hourly_counts(df, column, hour_name, count_name)
    return hours.orderBy(F.col(count_name).desc(), F.col(hour_name).asc_nulls_last()).limit(k)
