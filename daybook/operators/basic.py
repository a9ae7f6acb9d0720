"""The installation-check operations: generated rows, SQL over a view, filter + arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def sequence(spark: SparkSession, n: int) -> DataFrame:
    """``id BIGINT`` 0..n-1, split across the default parallelism."""
    return spark.range(n)


def row_count(df: DataFrame, name: str = "total_rows") -> DataFrame:
    """One row with the number of rows; reads no column data from parquet."""
    return df.agg(F.count(F.lit(1)).alias(name))


def sql_count(df: DataFrame, view: str = "test_table", name: str = "total") -> DataFrame:
    """``SELECT COUNT(*) AS total FROM <view>`` after registering ``df`` as a temp view."""
    if not view.isidentifier():
        raise ValueError(f"bad view name {view!r}")
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(f"SELECT COUNT(*) AS {name} FROM {view}")


def even_double(df: DataFrame, column: str = "id", name: str = "id2") -> DataFrame:
    """Keep even values of ``column`` and double them (one codegen stage, no shuffle)."""
    c = F.col(column)
    return df.where(c % 2 == 0).select((c * 2).alias(name))


def first_value(df: DataFrame, column: str):
    """The first row's ``column``: the one place a scalar comes back to the driver."""
    row = df.first()
    return None if row is None else row[column]


def sort_small(df: DataFrame, *order: str | Column) -> DataFrame:
    """Sort a result that is small by construction (days, hours, a report) in one partition.

    ``orderBy`` plans a range-partitioned exchange whose bounds come from a
    sample job over its input, so the aggregation feeding it runs twice.
    Moving the finished rows into one partition (a shuffle of the small
    result only) and sorting there runs it once.
    """
    return df.repartition(1).sortWithinPartitions(*order)
