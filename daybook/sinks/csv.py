"""CSV outputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from daybook.operators.basic import sort_small

# Output file names. The daily run writes DAILY_CSV; the
# activity run writes one CSV per stem, named "{stem}_{mode}.csv".
DAILY_CSV = "daily_averages.csv"
OUTPUT_STEMS = ("dataset_stats", "top_subreddits", "peak_hours")
MODES = ("local", "cluster")


def output_names(mode: str) -> dict[str, str]:
    """``{stem: f"{stem}_{mode}.csv"}`` for the three activity outputs."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    return {stem: f"{stem}_{mode}.csv" for stem in OUTPUT_STEMS}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Distributed CSV with a header: one part file per partition, written by the executors."""
    df.write.mode(mode).option("header", True).csv(path)
    return path


def write_small_csv(
    df: DataFrame,
    path: str,
    order_by: Sequence[Column | str] = (),
    *,
    max_rows: int | None,
    mode: str = "overwrite",
) -> str:
    """One CSV part file with a header, for a small result (a report table).

    The result is moved into one partition with ``repartition(1)`` (a shuffle
    of the small result only; ``coalesce(1)`` would pull the stage that
    computes it into one task) and sorted there by ``order_by``.
    The size is checked first: a result over ``max_rows`` rows is refused
    rather than funnelled through one task. The check is one more job over the
    result, so pass a checkpointed result, or ``max_rows=None`` when the size
    is bounded by construction (one row, a top-k, 24 hours).
    """
    if max_rows is not None and df.limit(max_rows + 1).count() > max_rows:
        raise ValueError(f"result has more than {max_rows} rows; use write_csv")
    one = sort_small(df, *order_by) if order_by else df.repartition(1)
    one.write.mode(mode).option("header", True).csv(path)
    return path
