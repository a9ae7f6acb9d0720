"""The command line, in its own process (it owns and stops its session)."""

from __future__ import annotations

import glob
import subprocess
import sys

from tests.conftest import ROOT


def run(*args: str) -> subprocess.CompletedProcess:
    return subprocess.run(
        [sys.executable, "-m", "daybook.cli", "--master", "local[2]", "--conf", "spark.ui.showConsoleProgress=false", *args],
        cwd=ROOT,
        capture_output=True,
        text=True,
        timeout=300,
    )


def test_cli_daily_and_check(tmp_path):
    out = str(tmp_path / "daily_averages.csv")
    p = run(
        "daily", "--paths", "/root/testdata/sf0.001/lineitem.parquet", str(tmp_path / "missing.parquet"),
        "--year", "1995", "--ts", "l_shipdate", "--distance", "l_extendedprice", "--tax", "l_tax",
        "--fare", "l_extendedprice", "--tip", "l_discount", "--passengers", "l_quantity", "--out", out,
        "--explore",
    )
    assert p.returncode == 0, p.stderr[-2000:]
    assert "skipped" in p.stdout and "not_found" in p.stdout
    assert "Rows read: 6,0" in p.stdout and "Days with data:" in p.stdout
    assert "Input: 1 files" in p.stdout and "  l_shipdate: timestamp_ntz" in p.stdout and "dt_year" in p.stdout
    assert len(glob.glob(f"{out}/part-*.csv")) == 1
    p = run("probe", str(tmp_path / "nope"))
    assert p.returncode == 1 and "not_found" in p.stdout


def test_cli_sizes_for_input():
    p = subprocess.run(
        [sys.executable, "-m", "daybook.cli", "--master", "local[2]", "--input-gb", "2000", "--total-cores", "64", "check"],
        cwd=ROOT,
        capture_output=True,
        text=True,
        timeout=300,
    )
    assert p.returncode == 0, p.stderr[-2000:]
    assert "spark.sql.shuffle.partitions=2000" in p.stdout
    assert f"spark.sql.files.maxPartitionBytes={512 * 1024 * 1024}" in p.stdout


def test_cli_auto_size(tmp_path):
    p = subprocess.run(
        [
            sys.executable, "-m", "daybook.cli", "--master", "local[2]", "--auto-size", "--total-cores", "4",
            "--conf", "spark.ui.showConsoleProgress=false",
            "activity", "--input", "/root/testdata/sf0.001/events.parquet", "--id-col", "event_id",
            "--user-col", "user_id", "--group-col", "event_type", "--time-col", "ts", "--out-dir", str(tmp_path),
        ],
        cwd=ROOT,
        capture_output=True,
        text=True,
        timeout=300,
    )
    assert p.returncode == 0, p.stderr[-2000:]
    # A tiny input: two shuffle partitions per core, at least one split per core.
    assert "-> 8 shuffle partitions" in p.stdout
    assert len(glob.glob(f"{tmp_path}/peak_hours_local.csv/part-*.csv")) == 1


TRIP_ARGS = (
    "--year", "1995", "--ts", "l_shipdate", "--distance", "l_extendedprice", "--tax", "l_tax",
    "--fare", "l_extendedprice", "--tip", "l_discount", "--passengers", "l_quantity",
)


def test_cli_shows_all_that_is_asked_for(tmp_path):
    p = run("daily", "--paths", "/root/testdata/sf0.001/lineitem.parquet", *TRIP_ARGS, "--show", "50", "--out", str(tmp_path / "o"))
    assert p.returncode == 0, p.stderr[-2000:]
    assert sum(line.startswith("|1995") for line in p.stdout.splitlines()) == 50


def test_cli_activity_shows_rows_without_a_time_and_whole_names(tmp_path, spark):
    long_name = "a_group_with_a_name_of_more_than_twenty_letters"
    rows = [(i, "u", long_name, i * 3600 if i < 24 else None) for i in range(30)]
    path = str(tmp_path / "ev")
    spark.createDataFrame(rows, "id long, author string, subreddit string, created_utc long").write.parquet(path)
    p = run("activity", "--input", path, "--id-col", "id", "--out-dir", str(tmp_path))
    assert p.returncode == 0, p.stderr[-2000:]
    lines = [line.replace(" ", "") for line in p.stdout.splitlines()]
    assert f"|{long_name}|30|" in lines and "|NULL|6|" in lines and "|23|1|" in lines


def test_cli_refuses_arguments_it_would_ignore(tmp_path):
    p = run("daily", "--paths", "x.parquet", "--months", "1-1")
    assert p.returncode == 2 and "--months" in p.stderr
    p = run("--input-gb", "3", "check")
    assert p.returncode == 2 and "--total-cores" in p.stderr


def test_cli_ls(tmp_path):
    for i in range(12):
        (tmp_path / f"f{i:02d}").write_bytes(b"x")
    p = run("ls", str(tmp_path))
    assert p.returncode == 0 and "12 files" in p.stdout and "f09" in p.stdout and "f10" not in p.stdout and "and 2 more" in p.stdout
    assert run("ls", str(tmp_path / "none")).returncode == 1


def test_cli_states_copy_and_index(spark, tmp_path):
    import datetime as dt

    root = tmp_path / "trips"
    ddl = "tpep_pickup_datetime timestamp, trip_distance double, mta_tax double, fare_amount double, tip_amount double, passenger_count double"
    for m in (1, 2, 3):
        rows = [(dt.datetime(2021, m, 1 + i % 28, i % 24), float(i), 0.5, 10.0 + i, 1.0, 2.0) for i in range(56)]
        spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(f"{root}/yyyy=2021/yellow_tripdata_2021-{m:02d}.parquet")
    out, states = str(tmp_path / "daily.csv"), str(tmp_path / "states")
    p = run("daily", "--root", str(root), "--year", "2021", "--months", "1-2", "--states", states, "--out", out)
    assert p.returncode == 0, p.stderr[-2000:]
    assert "Months read: 2021-01, 2021-02; from the store: 0" in p.stdout and "Days with data: 56" in p.stdout
    p = run("daily", "--root", str(root), "--year", "2021", "--months", "1-4", "--states", states, "--out", out)
    assert "Months read: 2021-03, 2021-04; from the store: 2" in p.stdout and "2021-04.parquet: not_found" in p.stdout
    assert p.returncode == 0 and "Days with data: 84" in p.stdout
    assert len(glob.glob(f"{out}/part-*.csv")) == 1

    p = run("index", str(root), "--out", str(tmp_path / "index"))
    assert p.returncode == 0 and "3 files, 168 rows, 0 unreadable, 0 without bounds" in p.stdout, p.stdout
    assert spark.read.parquet(str(tmp_path / "index")).count() == 3
    spark.range(10).selectExpr("id", "2024 AS yyyy", "id % 2 + 1 AS mm").write.partitionBy("yyyy", "mm").parquet(str(tmp_path / "src"))
    dst = str(tmp_path / "dst")
    p = run("copy", str(tmp_path / "src"), dst, "--where", "mm=1")
    assert p.returncode == 0 and "copied yyyy=2024/mm=1\n" in p.stdout and "1 partitions" in p.stdout
    p = run("copy", str(tmp_path / "src"), dst)
    assert "copied yyyy=2024/mm=2\n1 partitions" in p.stdout
