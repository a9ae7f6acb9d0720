"""A result in total order over many files.

``sort_small`` moves a small result into one task. Here rows are dealt to
``files`` ranges of their sort keys, each range sorted in its own task and
written as one part; parts in the order of their names hold the rows in order.

The number of files follows from the counted rows. Ranges are cut by the keys
and then by a hash of the whole row and a number of its own, so a key that
holds a third of all rows is spread over as many files as its rows fill.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_FILE = 5_000_000


def in_ranges(df: DataFrame, order_by: Sequence[Column], files: int) -> DataFrame:
    """``df`` in ``files`` partitions that follow each other in the order of ``order_by``, each sorted."""
    if not order_by or files < 1:
        raise ValueError("need sort keys and at least one file")
    # The row's own number makes equal rows differ, so that no range has to hold all of them. Both
    # follow the keys, so they decide between equal keys only.
    ties = df.withColumns({"_h": F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), "_i": F.monotonically_increasing_id()})
    ranged = ties.repartitionByRange(files, *order_by, "_h", "_i").sortWithinPartitions(*order_by, "_h", "_i")
    return ranged.drop("_h", "_i")


def write_sorted_csv(
    df: DataFrame, path: str, order_by: Sequence[Column], rows_per_file: int = ROWS_PER_FILE, mode: str = "overwrite"
) -> int:
    """CSV parts with a header whose names follow the total order; returns the number of parts planned.

    The rows are counted first (one more job over the result: pass a
    checkpointed one if it is dear).
    """
    files = max(1, ceil(df.count() / rows_per_file))
    in_ranges(df, order_by, files).write.mode(mode).option("header", True).csv(path)
    return files


def positions(parts: DataFrame, name: str = "position") -> DataFrame:
    """Rows read from sorted parts with their place in the whole order, from 1 on.

    A row's place is the number of rows in earlier files plus its own in its
    file: one row per file is summed up, no task holds more than a file.
    """
    rows = parts.withColumns({"_file": F.col("_metadata.file_name"), "_at": F.monotonically_increasing_id()})
    sizes = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_file").orderBy("_at"))
    return rows.join(offsets, "_file").withColumn(name, (F.col("_before") + inside).cast("bigint")).drop("_file", "_at", "_before")
