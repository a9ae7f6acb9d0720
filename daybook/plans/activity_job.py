"""The activity run: distinct counts, busiest groups, hourly histogram.

Three aggregations. They read disjoint column sets (id + author, group key,
time), so with column pruning three scans read the same bytes as one shared
scan would; each is one shuffle of pre-aggregated rows. The outputs are
small (1, ``top_n`` and at most 25 rows: 24 hours and rows without a time).
Each result is checkpointed once; showing and writing read it from there.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.operators.activity import distinct_stats, hourly_counts, top_groups
from daybook.operators.basic import sort_small
from daybook.session import ensure_checkpoint_dir
from daybook.sinks.csv import output_names, write_small_csv


@dataclass
class ActivityRun:
    stats: DataFrame
    top: DataFrame
    hours: DataFrame
    outputs: dict[str, str] = field(default_factory=dict)


def run_activity(
    df: DataFrame,
    id_col: str,
    user_col: str = "author",
    group_col: str = "subreddit",
    time_col: str = "created_utc",
    top_n: int = 10,
    approx: bool = False,
    out_dir: str | None = None,
    mode: str = "local",
) -> ActivityRun:
    """Run the three analyses; write ``dataset_stats_{mode}.csv`` etc. under ``out_dir``.

    ``id_col`` names the comment id (the source names none). ``approx=True``
    replaces exact distinct counts with HyperLogLog++ sketches.
    """
    ensure_checkpoint_dir(df.sparkSession)
    stats = distinct_stats(df, {"unique_comments": id_col, "unique_users": user_col}, approx=approx).checkpoint()
    top = top_groups(df, group_col, top_n).checkpoint()
    hours = sort_small(hourly_counts(df, time_col), F.col("hour").asc_nulls_last()).checkpoint()
    outputs: dict[str, str] = {}
    if out_dir:
        names = output_names(mode)
        orders = {
            "dataset_stats": [],
            "top_subreddits": [F.col("n").desc(), F.col(group_col).asc_nulls_last()],
            "peak_hours": [F.col("hour").asc_nulls_last()],
        }
        for stem, frame in (("dataset_stats", stats), ("top_subreddits", top), ("peak_hours", hours)):
            # Sizes are bounded by construction: 1 row, top_n rows, 24 hours and one without.
            path = os.path.join(out_dir, names[stem])
            outputs[stem] = write_small_csv(frame, path, orders[stem], max_rows=None)
    return ActivityRun(stats, top, hours, outputs)
