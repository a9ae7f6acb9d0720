"""Distinct counts that add up: HyperLogLog states, and exact counts in hash-range passes.

A state is a HyperLogLog sketch of fixed size per column. States are made per
scan task and salt, then merged (two levels, as in ``states``), can be stored,
and merge with those of other months, files or partitions.

Exact counts take one column at a time: its distinct values are dropped in each
task, shuffled once and counted, without ``Expand`` (Catalyst's plan for
several distinct counts, which writes each row once per column). The values are
worked through in ``passes`` ranges of their hash, so that the share of one
reduce task stays below a number of values however many ids there are; the
sketches tell how many passes that takes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.operators.states import SALTS

SIZE = 14  # log2 of a sketch's registers
MOST_VALUES = 4_000_000  # distinct values that one reduce task holds


def relative_error(size: int = SIZE) -> float:
    """Relative standard error of an estimate from a sketch of ``2**size`` registers."""
    return 1.04 / 2 ** (size / 2)


def distinct_states(
    df: DataFrame, columns: Mapping[str, str], keys: Sequence[str] = (), size: int = SIZE, salts: int = SALTS
) -> DataFrame:
    """Per group of ``keys`` (or one row) and ``alias -> column``: a sketch of the column's distinct non-NULL values."""
    typed = [F.col(c).cast("string" if df.schema[c].dataType.simpleString() not in ("int", "bigint") else "bigint").alias(f"_{a}") for a, c in columns.items()]
    rows = df.select(*keys, *typed, F.pmod(F.spark_partition_id(), F.lit(salts)).alias("_salt"))
    partial = rows.groupBy(*keys, "_salt").agg(*[F.hll_sketch_agg(f"_{a}", size).alias(a) for a in columns])
    return merged_distinct(partial.drop("_salt"), list(columns), keys)


def merged_distinct(states: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """States of one group as one (union of what they have seen)."""
    return states.groupBy(*keys).agg(*[F.hll_union_agg(c).alias(c) for c in columns])


def distinct_estimates(states: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``states`` with each sketch replaced by its estimate (0 for one that has seen nothing)."""
    return states.withColumns({c: F.coalesce(F.hll_sketch_estimate(c), F.lit(0)) for c in columns})


def passes_for(estimate: int, partitions: int, most_values: int = MOST_VALUES) -> int:
    """Hash ranges to work through so that a reduce task holds about ``most_values`` values at most."""
    return max(1, ceil(estimate / (most_values * max(1, partitions))))


def exact_distinct(
    df: DataFrame, columns: Mapping[str, str], passes: int | None = None, most_values: int = MOST_VALUES
) -> DataFrame:
    """One row: for each ``alias -> column`` the number of distinct non-NULL values, exactly.

    ``passes=None`` asks the sketches first. Each pass of each column is a job
    that reads one column.
    """
    if not columns:
        raise ValueError("no columns given")
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if passes is None:
        told = distinct_estimates(distinct_states(df, columns), list(columns)).first()
        wanted = {a: passes_for(told[a], partitions, most_values) for a in columns}
    else:
        wanted = dict.fromkeys(columns, passes)
    totals = []
    for alias, column in columns.items():
        values = df.select(F.col(column).alias("v")).where(F.col("v").isNotNull())
        n = wanted[alias]
        part = F.pmod(F.xxhash64("v"), F.lit(n))
        totals.append(sum((values if n == 1 else values.where(part == i)).distinct().count() for i in range(n)))
    return spark.createDataFrame([tuple(totals)], ", ".join(f"`{a}` bigint" for a in columns))
