"""Parquet footers read by the executors: one small row per file, and an index of files by time.

``read_footers`` deals a list of files to tasks; a task opens each file's
footer only (a few KB at its end, no column data) and returns what a load
needs to know: whether the file is readable, a signature of its schema, its
columns, its rows, and the bounds of one time column. The driver then handles
one row per file instead of one round trip per file, and asks Spark for one
schema per distinct signature.

Tasks open files with Arrow's file systems, which know local (shared) paths,
``hdfs`` and ``s3``/``s3a`` (endpoint, region and keys are taken from Spark's
``fs.s3a`` settings). Other schemes are left to the driver (``opens``).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator, Mapping
from datetime import date, datetime, timezone
from functools import lru_cache

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.session import importable

LOCAL = ("", "file")
SCHEMES = (*LOCAL, "hdfs", "s3", "s3a")
FILES_PER_TASK = 64

FOOTERS = (
    "path string, status string, error string, signature string, columns array<string>, "
    "rows bigint, row_groups int, low bigint, high bigint"
)
READ, FAILED = "ok", "failed"

# Key under which Spark writes its own schema into a footer.
SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"


def parts(path: str) -> tuple[str, str, str]:
    """Scheme, host and path. Paths are given unescaped, as Spark takes them."""
    scheme, host, inside = re.fullmatch(r"(?s)(?:([A-Za-z][\w+.-]*):)?(?://([^/]*))?(.*)", path).groups()
    return (scheme or "").lower(), host or "", inside


def opens(path: str) -> bool:
    """Whether tasks can open a path of this scheme themselves."""
    return parts(path)[0] in SCHEMES


def s3_settings(spark: SparkSession) -> dict[str, str]:
    """The session's ``fs.s3a`` settings in Arrow's names."""
    names = {
        "fs.s3a.access.key": "access_key",
        "fs.s3a.secret.key": "secret_key",
        "fs.s3a.session.token": "session_token",
        "fs.s3a.endpoint": "endpoint_override",
        "fs.s3a.endpoint.region": "region",
    }
    found = {new: spark.conf.get(f"spark.hadoop.{old}", None) for old, new in names.items()}
    return {k: v for k, v in found.items() if v}


@lru_cache(maxsize=8)
def _filesystem(scheme: str, host: str, settings: tuple) -> pafs.FileSystem:
    if scheme in LOCAL:
        return pafs.LocalFileSystem()
    if scheme == "hdfs":
        return pafs.FileSystem.from_uri(f"hdfs://{host}/")[0]
    return pafs.S3FileSystem(**dict(settings))


def located(path: str, settings: Mapping[str, str]) -> tuple[pafs.FileSystem, str]:
    """A path's file system and its path there."""
    scheme, host, inside = parts(path)
    if scheme in LOCAL:
        return _filesystem("", "", ()), inside
    if scheme in ("s3", "s3a"):
        return _filesystem("s3", "", tuple(sorted(settings.items()))), host + inside
    return _filesystem(scheme, host, ()), inside


def micros(value) -> int | None:
    """A footer's bound of a date or timestamp column in microseconds since the epoch, clock time as it stands."""
    if isinstance(value, datetime):
        if value.tzinfo is None:
            value = value.replace(tzinfo=timezone.utc)
        delta = value - datetime(1970, 1, 1, tzinfo=timezone.utc)
        return (delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds
    if isinstance(value, date):
        return (value - date(1970, 1, 1)).days * 86_400_000_000
    return None


def bounds(meta: pq.FileMetaData, column: str | None) -> tuple[int | None, int | None]:
    """Smallest and largest value of a time column over all row groups; None where a footer does not tell.

    Row groups that hold only NULL have none to add.
    """
    names = meta.schema.names
    if column is None or column not in names:
        return None, None
    at, lows, highs = names.index(column), [], []
    for g in range(meta.num_row_groups):
        chunk = meta.row_group(g).column(at)
        stats = chunk.statistics
        if stats is not None and stats.has_null_count and stats.null_count == chunk.num_values:
            continue
        if stats is None or not stats.has_min_max:
            return None, None
        low, high = micros(stats.min), micros(stats.max)
        if low is None or high is None:
            return None, None
        # Arrow shows nanoseconds cut to microseconds: one more on top is safe.
        lows.append(low)
        highs.append(high + 1)
    return (min(lows), max(highs)) if lows else (None, None)


def footer(path: str, column: str | None, settings: Mapping[str, str]) -> tuple:
    """One row of ``FOOTERS`` for one file; a failure is a row too."""
    try:
        fs, inside = located(path, settings)
        with fs.open_input_file(inside) as f:
            meta = pq.ParquetFile(f).metadata
        written = (meta.metadata or {}).get(SPARK_SCHEMA, b"")
        physical = "\n".join(
            f"{c.path}|{c.physical_type}|{c.logical_type}|{c.converted_type}|{c.max_definition_level}|{c.max_repetition_level}"
            for c in (meta.schema.column(i) for i in range(len(meta.schema)))
        )
        signature = hashlib.sha256(written + b"\n" + physical.encode()).hexdigest()
        columns = list(dict.fromkeys(meta.schema.to_arrow_schema().names))
        return (path, READ, None, signature, columns, meta.num_rows, meta.num_row_groups, *bounds(meta, column))
    except Exception as exc:  # noqa: BLE001 - a file that can't be read is reported, not raised
        return (path, FAILED, f"{type(exc).__name__}: {exc}", None, None, None, None, None, None)


def read_footers(spark: SparkSession, files: Iterable[str], column: str | None = None) -> DataFrame:
    """One row of ``FOOTERS`` per file, read by the executors; ``column`` names a time column for the bounds.

    ``low`` and ``high`` are microseconds since the epoch (NULL: the footer
    does not tell, or all values are NULL).
    """
    importable(spark)
    settings = s3_settings(spark)
    kinds = [pa.string()] * 4 + [pa.list_(pa.string()), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
    names = [f.strip().split()[0] for f in FOOTERS.split(",")]
    paths = list(files)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [footer(p, column, settings) for p in batch.column(0).to_pylist()]
            columns = list(zip(*rows)) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    tasks = max(1, min(len(paths), max(len(paths) // FILES_PER_TASK, 2 * spark.sparkContext.defaultParallelism)))
    listed = spark.createDataFrame([(p,) for p in paths], "path string").repartition(tasks)
    return listed.mapInArrow(run, FOOTERS)


def overlapping(index: DataFrame, low: int, high: int) -> DataFrame:
    """The files of an index that may hold a time in ``[low, high)`` (microseconds).

    A file whose bounds are unknown stays; one without rows goes.
    """
    unknown = F.col("low").isNull() | F.col("high").isNull()
    inside = (F.col("high") >= low) & (F.col("low") < high)
    return index.where((F.col("status") == READ) & (F.col("rows") > 0) & (unknown | inside))
