"""File listings, input sizes and source probes, as small DataFrames."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.sources.errors import NOT_FOUND, OK, classify_error

PROBE_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("rows", T.LongType()),
        T.StructField("n_columns", T.IntegerType()),
        T.StructField("schema_ddl", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)


def list_files(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = False) -> DataFrame:
    """``path``, ``name``, ``length`` (bytes), ``modificationTime`` of each file.

    Uses the ``binaryFile`` source with the ``content`` column left out, so no
    file body is read (the column is pruned from the scan). Listing of many
    directories is parallelised by Spark itself.
    """
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    files = reader.load(path).select("path", "length", "modificationTime")
    return files.withColumn("name", F.element_at(F.split("path", "/"), -1)).select(
        "path", "name", "length", "modificationTime"
    )


@dataclass
class Directory:
    """What a directory holds: whether it exists, its first names in order, and how many more there are."""

    exists: bool
    names: list[str]
    rest: int


def list_directory(spark: SparkSession, path: str, first: int = 10, recursive: bool = False) -> Directory:
    """The first ``first`` file names of ``path`` and the number of the others; missing paths do not raise."""
    try:
        files = list_files(spark, path, recursive=recursive)
    except Exception as exc:  # noqa: BLE001 - a missing path is an answer, anything else is not
        if classify_error(exc) == NOT_FOUND:
            return Directory(False, [], 0)
        raise
    names = [r.name for r in files.select("name", "path").orderBy("name", "path").limit(first).collect()]
    return Directory(True, names, files.count() - len(names))


def input_size(files: DataFrame) -> DataFrame:
    """One row: number of files, total bytes and total MB of a listing."""
    return files.agg(
        F.count(F.lit(1)).alias("n_files"),
        F.coalesce(F.sum("length"), F.lit(0)).cast("bigint").alias("total_bytes"),
        F.round(F.coalesce(F.sum("length"), F.lit(0)) / F.lit(1024 * 1024), 1).alias("total_mb"),
    )


def probe_sources(spark: SparkSession, paths: Sequence[str], stop_at_first: bool = True) -> DataFrame:
    """Try candidate paths in order; one result row per path tried.

    A readable path gets ``status='ok'``, its row count (a count reads no
    column data), column count and schema. A failing path gets a label from
    ``classify_error`` and the message. With ``stop_at_first`` the probe ends
    at the first readable path.
    """
    rows = []
    for p in paths:
        try:
            df = spark.read.parquet(p)
            n = df.count()
        except Exception as exc:  # noqa: BLE001 - reported, not raised, like the diagnosis it replaces
            rows.append((p, classify_error(exc), None, None, None, str(exc) or type(exc).__name__))
            continue
        rows.append((p, OK, n, len(df.columns), df.schema.simpleString(), None))
        if stop_at_first:
            break
    return spark.createDataFrame(rows, PROBE_SCHEMA)
