"""Calendar and clock expressions.

Every helper returns a built-in Column expression, so it stays inside
whole-stage codegen and Catalyst can fold, prune and push it down.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SECONDS_PER_DAY = 86400
SECONDS_PER_HOUR = 3600


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_parts(ts: str | Column, prefix: str = "dt_") -> dict[str, Column]:
    """``{prefix}year``, ``{prefix}month``, ``{prefix}day`` (all INT)."""
    c = _col(ts)
    return {
        f"{prefix}year": F.year(c),
        f"{prefix}month": F.month(c),
        f"{prefix}day": F.dayofmonth(c),
    }


def with_date_parts(df: DataFrame, ts: str, prefix: str = "dt_") -> DataFrame:
    """Add year / month / day-of-month columns derived from ``ts``."""
    return df.withColumns(date_parts(ts, prefix))


def _literal_like(df: DataFrame, column: str, text: str) -> Column:
    """A literal cast to the column's own type.

    A literal of the same type keeps the comparison free of casts on the
    column side, so the parquet reader receives it as a pushed filter.
    """
    dtype = df.schema[column].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.lit(text).cast(dtype)
    raise TypeError(f"{column} is {dtype.simpleString()}, expected a date or timestamp")


def year_range(df: DataFrame, ts: str, year: int) -> Column:
    """``ts`` falls in calendar ``year``: the half-open range form.

    Same rows as ``year(ts) = year`` (NULL drops out of both), but this form
    reaches the scan as ``GreaterThanOrEqual`` / ``LessThan`` so row groups
    and files outside the year are skipped.
    """
    c = F.col(ts)
    lo = _literal_like(df, ts, f"{year:04d}-01-01 00:00:00")
    hi = _literal_like(df, ts, f"{year + 1:04d}-01-01 00:00:00")
    return (c >= lo) & (c < hi)


def year_equals(ts: str | Column, year: int) -> Column:
    """The reference's own form, ``year(ts) = year`` (no range pushdown)."""
    return F.year(_col(ts)) == F.lit(year)


def months_between_range(df: DataFrame, ts: str, year: int, first: int, last: int) -> Column:
    """``ts`` falls in months ``first..last`` of ``year`` (inclusive), range form."""
    if not 1 <= first <= last <= 12:
        raise ValueError(f"bad month range {first}..{last}")
    c = F.col(ts)
    lo = _literal_like(df, ts, f"{year:04d}-{first:02d}-01 00:00:00")
    if last == 12:
        hi = _literal_like(df, ts, f"{year + 1:04d}-01-01 00:00:00")
    else:
        hi = _literal_like(df, ts, f"{year:04d}-{last + 1:02d}-01 00:00:00")
    return (c >= lo) & (c < hi)


def epoch_seconds(df: DataFrame, column: str) -> Column:
    """Seconds since 1970-01-01 UTC as BIGINT, whatever the column type.

    * integral: taken as epoch seconds already (``created_utc``);
    * TIMESTAMP_NTZ: wall clock read as UTC, zone-free;
    * TIMESTAMP: an instant, so ``unix_seconds`` is exact in any session zone.
    """
    dtype = df.schema[column].dataType
    c = F.col(column)
    if isinstance(dtype, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return c.cast("bigint")
    if isinstance(dtype, T.TimestampNTZType):
        # Day number + clock parts: no cast through the session zone
        # (``timestampdiff`` on NTZ casts both sides to TIMESTAMP first).
        return (
            F.unix_date(F.to_date(c)).cast("bigint") * F.lit(SECONDS_PER_DAY)
            + F.hour(c) * F.lit(SECONDS_PER_HOUR)
            + F.minute(c) * F.lit(60)
            + F.second(c)
        )
    if isinstance(dtype, T.TimestampType):
        return F.unix_seconds(c)
    raise TypeError(f"{column} is {dtype.simpleString()}, expected epoch seconds or a timestamp")


def hour_utc(epoch: str | Column) -> Column:
    """Hour of day (INT 0-23) in UTC from epoch seconds.

    ``hour(from_unixtime(x))`` follows the session time zone; this form does
    not. ``pmod`` keeps instants before 1970 in 0..86399.
    """
    c = _col(epoch)
    return F.floor(F.pmod(c, F.lit(SECONDS_PER_DAY)) / F.lit(SECONDS_PER_HOUR)).cast("int")


def hour_of_day(df: DataFrame, column: str) -> Column:
    """UTC hour of day for an epoch-seconds or timestamp column."""
    return hour_utc(epoch_seconds(df, column))


def date_bounds(spark: SparkSession, year: int, months: tuple[int, int] | None = None) -> tuple[int, int]:
    """A period as microseconds since the epoch, ``[low, high)``, wide enough for both kinds of timestamps.

    A TIMESTAMP_NTZ is stored as its clock time, a TIMESTAMP as an instant
    that the session's time zone shows: the earlier start and the later end.
    """
    first, last = months or (1, 12)
    start = f"{year:04d}-{first:02d}-01"
    end = f"{year + 1:04d}-01-01" if last == 12 else f"{year:04d}-{last + 1:02d}-01"
    clock = [F.unix_date(F.lit(d).cast("date")).cast("bigint") * F.lit(SECONDS_PER_DAY * 1_000_000) for d in (start, end)]
    instant = [F.unix_micros(F.lit(f"{d} 00:00:00").cast("timestamp")) for d in (start, end)]
    row = spark.range(1).select(F.least(clock[0], instant[0]).alias("low"), F.greatest(clock[1], instant[1]).alias("high")).first()
    return row.low, row.high
