"""Copies of hive trees that can be repeated and stopped at any time.

``copy_new`` copies the partitions of a tree that hold files the copy has not
seen (by path, size and time of change). A run writes to a folder of its own,
counts the copied rows of every partition against the sources' rows, and only
then publishes a new version of the manifest. Readers go by the manifest: a
run that is killed, or whose counts differ, is never seen, and no partition is
ever half there. A partition with a new, changed or vanished file is copied
whole again and replaces its former copy.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.sources.errors import OK
from daybook.sources.footers import opens
from daybook.sources.listing import list_files
from daybook.sources.manifest import Manifest
from daybook.sources.tree import FILE, list_tree

FIELDS = "path string, length bigint, modified bigint, part string, rows bigint, run string"


@dataclass(frozen=True)
class Copied:
    """What a run copied: partitions (``yyyy=2024/mm=01``), their files and rows; ``files_total`` of the source."""

    partitions: list[str]
    files: int
    rows: int
    files_total: int


def source_files(spark: SparkSession, root: str) -> DataFrame:
    """``path`` (below the root), ``length``, ``modified``, ``part`` (its directory below the root) of a tree's files."""
    if opens(root):
        files = list_tree(spark, [root]).where((F.col("kind") == FILE) & (F.col("status") == OK))
    else:
        files = list_files(spark, root, recursive=True).withColumn("modified", F.unix_micros("modificationTime"))
    inside = F.substring_index(F.col("path"), root.split(":", 1)[-1].strip("/") + "/", -1)
    return files.select(inside.alias("path"), "length", "modified").select(
        "path", "length", "modified", F.regexp_replace("path", "/?[^/]*$", "").alias("part")
    )


def manifest(spark: SparkSession, dst_root: str) -> Manifest:
    return Manifest(spark, f"{dst_root.rstrip('/')}/_manifest", FIELDS)


def _counts(df: DataFrame) -> DataFrame:
    """Rows per partition directory; no column is read."""
    file = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return df.select(file.alias("file")).groupBy("file").agg(F.count(F.lit(1)).alias("n"))


def copy_new(
    spark: SparkSession,
    src_root: str,
    dst_root: str,
    partition_by: Sequence[str] = ("yyyy", "mm"),
    where: Mapping[str, object] | None = None,
) -> Copied:
    """Copy what is new below ``src_root``; partitions keep their directory names, other columns and rows stay.

    ``where``: only partitions of these values (as read from the directory names).
    """
    book, levels = manifest(spark, dst_root), len(partition_by)
    source = source_files(spark, src_root).checkpoint()
    if where:
        for k, v in where.items():
            name = F.regexp_extract(F.concat(F.col("part"), F.lit("/")), f"(?:^|/){k}=([^/]*)/", 1)
            same = (name == str(v)) | (name.cast("double") == F.lit(v).cast("double")) if isinstance(v, int) else name == str(v)
            source = source.where(same)
    total = source.count()
    held = book.rows()
    keys = ["path", "length", "modified"]
    fresh = source.join(held, keys, "left_anti").select("part")
    gone = held.join(source.select("part").distinct(), "part", "left_semi").join(source, "path", "left_anti").select("part")
    parts = sorted(r.part for r in fresh.union(gone).distinct().collect())  # one string per partition to copy
    if not parts:
        return Copied([], 0, 0, total)

    run = uuid.uuid4().hex
    folder = f"{dst_root.rstrip('/')}/run={run}"
    chosen = source.where(F.col("part").isin(parts))
    base = src_root.rstrip("/")
    df = spark.read.option("basePath", base).parquet(*[f"{base}/{p}" for p in parts])
    names = {k: F.regexp_extract(F.col("_metadata.file_path"), f"/{k}=([^/]*)/", 1) for k in partition_by}
    named = df.withColumns({k: F.url_decode(F.replace(v, F.lit("+"), F.lit("%2B"))) for k, v in names.items()})
    named.write.partitionBy(*partition_by).parquet(folder)

    # Rows of each source file and of each copied partition, from footers alone.
    read = _counts(df).select(F.col("n"), F.substring_index("file", base.split(":", 1)[-1].strip("/") + "/", -1).alias("path"))
    told = chosen.join(read, "path", "left").select(*keys, "part", F.coalesce("n", F.lit(0)).alias("rows")).checkpoint()
    want = {r.part: r.n for r in told.groupBy("part").agg(F.sum("rows").alias("n")).collect()}
    copied = _counts(spark.read.parquet(folder)) if any(want.values()) else None
    at = F.array_join(F.slice(F.split("file", "/"), -levels - 1, levels), "/")
    got = {r.part: r.n for r in copied.groupBy(at.alias("part")).agg(F.sum("n").alias("n")).collect()} if copied else {}
    differ = [p for p, n in want.items() if got.get(p, 0) != n]
    if differ:
        raise RuntimeError(f"{len(differ)} partitions differ from their source, first {differ[0]}: nothing published")
    # Counted without the files' names: rows that were ascribed to no listed file would be missed above.
    counted, scanned = sum(want.values()), df.count()
    if counted != scanned:
        raise RuntimeError(f"{counted} rows counted by file, {scanned} in all: nothing published")
    stay = held.where(~F.col("part").isin(parts))
    book.publish(stay.unionByName(told.withColumn("run", F.lit(run))).checkpoint())
    return Copied(parts, told.count(), sum(want.values()), total)


def read_copy(
    spark: SparkSession, dst_root: str, where: Mapping[str, object] | None = None, schema: T.StructType | None = None
) -> DataFrame:
    """The published rows of a copy, with the partition columns.

    Where none is published the result is empty with the ``schema`` given, else ``FileNotFoundError`` is raised.
    """
    runs: dict[str, list[str]] = {}
    published = manifest(spark, dst_root).rows().where("rows > 0").select("part", "run").distinct()
    for r in published.orderBy("part").collect():  # one row per partition
        runs.setdefault(r.run, []).append(r.part)
    if not runs and schema is not None:
        return spark.createDataFrame([], schema)
    if not runs:
        raise FileNotFoundError(f"nothing published in {dst_root}")
    parts = []
    for run, directories in runs.items():
        base = f"{dst_root.rstrip('/')}/run={run}"
        reader = spark.read.schema(schema) if schema is not None else spark.read
        parts.append(reader.option("basePath", base).parquet(*[f"{base}/{d}" for d in directories]))
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    for k, v in (where or {}).items():
        df = df.where(F.col(k) == F.lit(v))
    return df
