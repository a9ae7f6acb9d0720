"""Directory trees listed by the executors, one Spark job per level of the tree.

The driver's own listing walks a tree one directory after the other. Here each
level's directories are dealt to tasks; a task lists its directories and
returns their entries, files with sizes and sub-directories, which are the
next level's work. The driver only counts the directories of a level.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.session import ensure_checkpoint_dir, importable
from daybook.sources.errors import OK, label_of
from daybook.sources.footers import located, opens, s3_settings

ENTRIES = "root string, path string, kind string, length bigint, modified bigint, status string, error string"
FILE, DIRECTORY = "file", "directory"
DIRECTORIES_PER_TASK = 16


def _hidden(name: str) -> bool:
    return name.startswith((".", "_")) and "=" not in name


def _entries(root: str, path: str, settings: dict) -> list[tuple]:
    """A path's own row if it is a file or can't be listed, else one row per entry."""
    try:
        fs, inside = located(path, settings)
        info = fs.get_file_info(inside)
        if info.type == pafs.FileType.NotFound:
            raise FileNotFoundError(path)
        if info.type == pafs.FileType.File:
            return [(root, path, FILE, info.size, (info.mtime_ns or 0) // 1000, OK, None)]
        prefix = path.rstrip("/")
        found = []
        for e in fs.get_file_info(pafs.FileSelector(inside)):
            if not _hidden(e.base_name):
                kind = DIRECTORY if e.type == pafs.FileType.Directory else FILE
                found.append((root, f"{prefix}/{e.base_name}", kind, e.size or 0, (e.mtime_ns or 0) // 1000, OK, None))
        return found
    except Exception as exc:  # noqa: BLE001 - reported as a row
        told = f"{type(exc).__name__}: {exc}"
        return [(root, path, DIRECTORY, None, None, label_of(told), told)]


def list_tree(spark: SparkSession, roots: Iterable[str]) -> DataFrame:
    """``root, path, kind, length, modified, status, error``: every file below ``roots``, and what could not be listed.

    A root may be a file. Names that begin with a dot or an underscore are
    left out, as in Spark's own listing (partition directories with ``=`` stay).
    ``modified`` is in microseconds since the epoch. The scheme has to be one
    that tasks open themselves (``opens``).
    """
    roots = list(dict.fromkeys(roots))
    strange = [r for r in roots if not opens(r)]
    if strange:
        raise ValueError(f"tasks can't list {strange[0]}; use list_files")
    importable(spark)
    ensure_checkpoint_dir(spark)
    settings = s3_settings(spark)
    fields = [pa.string()] * 3 + [pa.int64()] * 2 + [pa.string()] * 2
    names = [f.strip().split()[0] for f in ENTRIES.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for root, path in zip(*(c.to_pylist() for c in batch.columns)):
                columns = list(zip(*_entries(root, path, settings)))
                if columns:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, fields)], names=names)

    level = spark.createDataFrame([(r, r) for r in roots], "root string, path string")
    count, levels = len(roots), []
    while count:
        tasks = max(1, min(count, max(count // DIRECTORIES_PER_TASK, 2 * spark.sparkContext.defaultParallelism)))
        found = level.repartition(tasks).mapInArrow(run, ENTRIES).checkpoint()
        levels.append(found.where((F.col("kind") == FILE) | (F.col("status") != OK)))
        level = found.where((F.col("kind") == DIRECTORY) & (F.col("status") == OK)).select("root", "path")
        count = level.count()
    if not levels:
        return spark.createDataFrame([], ENTRIES)
    return reduce(DataFrame.union, levels)


def tree_sizes(listing: DataFrame) -> DataFrame:
    """Files and bytes of each directory that holds files, summed by the executors."""
    directory = F.regexp_replace("path", "/[^/]*$", "")
    files = listing.where((F.col("kind") == FILE) & (F.col("status") == OK))
    return files.groupBy("root", directory.alias("directory")).agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("total_bytes")
    )
