"""A time index of many Parquet files, used to choose files before a scan is planned.

Spark skips row groups by their statistics only after it has opened a file.
With 100,000 monthly files, a query over six months would still open each.
The index holds one small row per file (from its footer, read by executors):
the bounds of the time column. ``read_period`` plans a scan over the files that
can hold a row of the period and no others.

Footers do not tell the bounds of INT96 timestamps (Spark's own default for
TIMESTAMP): for such files one column is read once, by a scan, when they are
indexed.

The index is an ordinary table: keep it as Parquet, and ``refreshed`` reads the
footers of files that are new or have another length or time of change.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.time import SECONDS_PER_DAY, date_bounds
from daybook.operators.daily import select_period
from daybook.sources.errors import OK
from daybook.sources.files import combined
from daybook.sources.footers import overlapping, read_footers
from daybook.sources.tree import FILE, list_tree

KEYS = ("path", "length", "modified")


def listed(spark: SparkSession, roots: Sequence[str]) -> DataFrame:
    """The data files below ``roots``: ``root, path, length, modified``."""
    tree = list_tree(spark, roots)
    return tree.where((F.col("kind") == FILE) & (F.col("status") == OK)).select("root", *KEYS)


def with_footers(spark: SparkSession, files: DataFrame, ts: str, scan: bool = True) -> DataFrame:
    """A listing with each file's footer row for the time column ``ts``; ``scan`` fills in bounds that footers lack."""
    paths = [r.path for r in files.select("path").distinct().toLocalIterator()]  # one string per file
    footers = read_footers(spark, paths, ts).checkpoint()
    told = files.join(footers, "path").select(
        "root", *KEYS, "status", "error", "signature", "columns", "rows", "row_groups", "low", "high"
    )
    silent = footers.where(F.col("low").isNull() & (F.col("rows") > 0) & F.array_contains("columns", ts))
    groups: dict[str, list[str]] = {}
    for r in silent.select("path", "signature").collect():
        groups.setdefault(r.signature, []).append(r.path)
    if not scan or not groups:
        return told
    scanned = reduce(DataFrame.union, [scanned_bounds(spark, fs, ts) for fs in groups.values()])
    keyed = told.withColumn("_at", plain_path(F.col("path"))).join(scanned, "_at", "left")
    return keyed.withColumns({"low": F.coalesce("low", "_low"), "high": F.coalesce("high", "_high")}).drop("_at", "_low", "_high")


def plain_path(path: Column) -> Column:
    """A path in one spelling: local ones without ``file:``."""
    return F.regexp_replace(path, "^file:/*", "/")


def scanned_bounds(spark: SparkSession, files: Sequence[str], ts: str) -> DataFrame:
    """``_at, _low, _high`` of files of one schema: their time column read once, aggregated per file in the tasks."""
    df = spark.read.parquet(*files)
    kind = df.schema[ts].dataType
    if isinstance(kind, T.TimestampType):
        at = F.unix_micros(ts)
    elif isinstance(kind, (T.TimestampNTZType, T.DateType)):
        at = F.unix_date(F.to_date(ts)).cast("bigint") * (SECONDS_PER_DAY * 1_000_000)
    else:
        at = F.lit(None).cast("bigint")
    whole = 0 if isinstance(kind, T.TimestampType) else SECONDS_PER_DAY * 1_000_000  # days: up to their end
    rows = df.select(F.col("_metadata.file_path").alias("_file"), at.alias("_m"))
    bounds = rows.groupBy("_file").agg(F.min("_m").alias("_low"), (F.max("_m") + whole).alias("_high"))
    file = F.url_decode(F.replace(F.col("_file"), F.lit("+"), F.lit("%2B")))  # Spark shows a URI
    return bounds.select(plain_path(file).alias("_at"), "_low", "_high")


def index_files(spark: SparkSession, roots: Sequence[str], ts: str) -> DataFrame:
    """The index of all files below ``roots`` by their time column ``ts``; one row per file, unreadable ones too."""
    return with_footers(spark, listed(spark, roots), ts).checkpoint()


def refreshed(spark: SparkSession, index: DataFrame, roots: Sequence[str], ts: str) -> DataFrame:
    """``index`` brought up to date with ``roots``: only new and changed files have their footers read."""
    now = listed(spark, roots).checkpoint()
    same = index.join(now, ["root", *KEYS], "left_semi")
    new = now.join(index.select("root", *KEYS), ["root", *KEYS], "left_anti")
    return same.unionByName(with_footers(spark, new, ts)).checkpoint()


@dataclass
class Period:
    """A period's rows, and how many files were chosen of how many."""

    df: DataFrame
    files_read: int
    files_total: int


def read_period(
    spark: SparkSession,
    index: DataFrame,
    ts: str,
    year: int,
    months: tuple[int, int] | None = None,
    schema: T.StructType | None = None,
) -> Period:
    """The rows of a year, or a month span of it, read from the files that may hold some.

    Files whose footers do not tell their bounds are read; unreadable ones
    are not (the index names them). Files are grouped by footer, as in
    ``read_months``. Where no file is left the result is empty with the
    ``schema`` given, else ``FileNotFoundError`` is raised.
    """
    low, high = date_bounds(spark, year, months)
    total = index.count()
    groups: dict[tuple[str, str | None], list[str]] = {}
    for r in overlapping(index, low, high).select("root", "path", "signature").orderBy("path").collect():
        groups.setdefault((r.signature, None if r.root == r.path else r.root), []).append(r.path)
    if not groups and schema is not None:
        return Period(spark.createDataFrame([], schema), 0, total)
    if not groups:
        raise FileNotFoundError(f"none of {total} files holds rows of {year} {months or ''}".rstrip())
    df = combined(spark, groups, schema, {})
    return Period(select_period(df, ts, year, months), sum(map(len, groups.values())), total)
