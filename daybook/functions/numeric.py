"""Numeric helpers over built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def nan_to_null(df: DataFrame, column: str) -> Column:
    """NaN becomes NULL for FLOAT/DOUBLE columns; other types pass through.

    ``ceil(avg(x))`` over a group holding NaN gives 0 in Spark (NaN cast to
    BIGINT); with NaN mapped to NULL first, the mean covers the real values.
    """
    c = F.col(column)
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return F.nanvl(c, F.lit(None).cast(df.schema[column].dataType))
    return c


def ceil_mean(c: Column) -> Column:
    """Mean rounded up to a whole number (BIGINT); NULL for an all-NULL group."""
    return F.ceil(F.avg(c))
