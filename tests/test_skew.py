"""One key holding half of all rows: results stay right, shuffles carry buffers, not rows.

``tests/skew_job.py`` runs in its own process (the event log must be on from
the session's start) over skewed copies of the sf0.01 tables: one day, one
user, one event type and one hour each hold half of all rows. The shuffle
figures come from Spark's event log (``tools/stage_metrics.py``).
"""

from __future__ import annotations

import subprocess
import sys

import pytest

from tests.conftest import ROOT, TESTDATA
from tools.stage_metrics import by_group

MAP_TASKS = 8  # the skewed copies are written as 8 files: at most 8 scan tasks


@pytest.fixture(scope="module")
def skew_run(tmp_path_factory):
    out = tmp_path_factory.mktemp("skew")
    p = subprocess.run(
        [sys.executable, str(ROOT / "tests" / "skew_job.py"), str(TESTDATA / "sf0.01"), str(out)],
        cwd=ROOT,
        capture_output=True,
        text=True,
        timeout=900,
    )
    assert p.returncode == 0, p.stderr[-3000:]
    lines = [line for line in p.stdout.splitlines() if line.startswith(("MATCH", "DIFF"))]
    return lines, by_group(str(out / "events"))


def test_results_match_under_skew(skew_run):
    lines, _ = skew_run
    assert len(lines) == 9
    assert all(line.startswith("MATCH") for line in lines), lines


@pytest.mark.parametrize(
    "name, keys, extra",
    [
        # one partial buffer per (scan task, day), plus the <= 366 finished days sorted in one partition
        ("daily_summary", 366, 366),
        ("top_groups", 151, 0),
        ("top_categories", 6, 0),
        ("hourly_counts", 24, 0),
        ("peak_hour", 24, 0),
        # distinct values per task, then one partial count per task
        ("distinct_count_nulls", 6, MAP_TASKS),
    ],
)
def test_shuffle_is_pre_aggregated(skew_run, name, keys, extra):
    _, groups = skew_run
    g = groups[name]
    assert g["input_records"] > 0
    assert g["shuffle_write_records"] <= MAP_TASKS * keys + extra
    # The hot key's rows (half of the input) never cross the shuffle as rows.
    assert g["max_task_shuffle_read_records"] < g["input_records"] / 20
