"""The daily and activity runs end to end on the test tables."""

from __future__ import annotations

import glob

from pyspark.sql import functions as F

from daybook.plans.activity_job import run_activity
from daybook.plans.daily_job import run_daily, timed
from daybook.plans.registry import LINEITEM_TRIPS, comments


def test_run_daily(spark, sf001, tmp_path):
    li = spark.read.parquet(f"{sf001}/lineitem.parquet")
    run = run_daily(li, LINEITEM_TRIPS, year=1995, out_csv=str(tmp_path / "daily"), mean_digits=6)
    assert run.total_rows == 60_000
    assert run.filtered_rows == 8_840
    assert run.total_days == 364
    assert run.first_rows.count() == 20
    assert len(run.report.collect()) == 5
    assert len(glob.glob(str(tmp_path / "daily" / "part-*.csv"))) == 1
    # The checkpointed result no longer depends on the scan.
    assert "Scan parquet" not in run.daily._jdf.queryExecution().executedPlan().toString()


def test_run_activity(spark, sf001, tmp_path):
    ev = comments(spark, sf001)
    run = run_activity(ev, "event_id", "user_id", "event_type", "created_utc", out_dir=str(tmp_path), mode="local")
    s = run.stats.first()
    assert (s.unique_comments, s.unique_users) == (10_000, 150)
    assert run.top.count() == 5
    assert run.hours.agg(F.sum("n")).first()[0] == 10_000
    for name in ("dataset_stats_local.csv", "top_subreddits_local.csv", "peak_hours_local.csv"):
        assert len(glob.glob(str(tmp_path / name / "part-*.csv"))) == 1


def test_timed():
    ok = timed(lambda: 3)
    assert ok.ok and ok.value == 3 and ok.seconds >= 0
    bad = timed(lambda: 1 / 0)
    assert not bad.ok and "ZeroDivisionError" in bad.error


def test_activity_results_are_evaluated_once(spark, sf0001):
    """Showing and counting a finished run reads its checkpoints, not the input."""
    from daybook.plans.activity_job import run_activity
    from daybook.plans.registry import comments

    run = run_activity(comments(spark, sf0001), "event_id", "user_id", "event_type", "created_utc")
    for frame in (run.stats, run.top, run.hours):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert "parquet" not in plan.lower() and frame.count() > 0
