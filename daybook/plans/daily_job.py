"""The daily-summary run: one aggregate, every output taken from its small result.

The reference's run triggers five actions over the input (count, filtered
count, show, count of days, toPandas), i.e. five scans. Here the input is
aggregated once; the <= 366-row-per-year result is checkpointed into
``spark.checkpoint.dir`` (reliable: survives lost executors, cuts lineage)
and the filtered count, number of days, overview, first rows, CSV and report
are all read from it. The only other scan is the unfiltered row count, which
reads no column data.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.operators.basic import row_count
from daybook.operators.daily import DAY_KEYS, TripColumns, daily_overview, daily_summary, newest_days
from daybook.session import ensure_checkpoint_dir
from daybook.sinks.csv import write_small_csv
from daybook.sinks.report import daily_report


@dataclass
class RunResult:
    """Outcome of a timed step: its value, seconds taken, success flag."""

    value: Any
    seconds: float
    ok: bool
    error: str | None = None


def timed(step: Callable[[], Any]) -> RunResult:
    """Run ``step``; report elapsed seconds and success instead of raising."""
    t0 = time.perf_counter()
    try:
        value = step()
    except Exception as exc:  # noqa: BLE001 - the run reports failure with an exit code
        return RunResult(None, time.perf_counter() - t0, False, f"{type(exc).__name__}: {exc}")
    return RunResult(value, time.perf_counter() - t0, True)


@dataclass
class DailyRun:
    daily: DataFrame
    total_rows: int
    filtered_rows: int
    total_days: int
    overview: DataFrame
    first_rows: DataFrame
    report: DataFrame
    outputs: dict[str, str] = field(default_factory=dict)


def run_daily(
    df: DataFrame,
    cols: TripColumns = TripColumns(),
    year: int | None = 2021,
    months: tuple[int, int] | None = None,
    out_csv: str | None = None,
    show_n: int = 20,
    report_n: int = 5,
    **summary_options: Any,
) -> DailyRun:
    """Daily summary of ``year`` with all of the run's figures.

    ``summary_options`` go to ``daily_summary`` (``accuracy``, ``exact``,
    ``quantile``, ``mean_digits``, ``nan_as_null``).
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    daily = daily_summary(df, cols, year=year, months=months, **summary_options).checkpoint(eager=True)

    total_rows = row_count(df).first()[0]
    overview = daily_overview(daily)
    ov = overview.first()
    outputs = {}
    if out_csv:
        newest_first = [F.col(k).desc() for k in DAY_KEYS]
        # One row per calendar day: bounded by construction, no size check needed.
        outputs["daily"] = write_small_csv(daily, out_csv, newest_first, max_rows=None)
    return DailyRun(
        daily=daily,
        total_rows=int(total_rows),
        filtered_rows=int(ov["total_trips"]),
        total_days=int(ov["total_days"]),
        overview=overview,
        first_rows=newest_days(daily, show_n),
        report=daily_report(daily, report_n),
        outputs=outputs,
    )
