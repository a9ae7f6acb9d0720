"""CSV outputs, reports, schema profile, guarded driver conversion."""

from __future__ import annotations

import csv
import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from daybook.operators.daily import daily_summary
from daybook.sinks import (
    daily_report,
    output_names,
    overview_report,
    sample_rows,
    schema_profile,
    to_pandas,
    write_csv,
    write_small_csv,
)
from daybook.operators.daily import daily_overview

TRIP_DDL = (
    "tpep_pickup_datetime timestamp_ntz, trip_distance double, mta_tax double, "
    "fare_amount double, tip_amount double, passenger_count double"
)


@pytest.fixture()
def daily(spark):
    rows = [
        (dt.datetime(2021, 6, 30, 8), 2.345, 0.5, 12.5, 1.0, 1.0),
        (dt.datetime(2021, 6, 30, 9), 3.0, 0.5, 20.0, 0.0, 2.0),
        (dt.datetime(2021, 6, 29, 9), 1.0, 0.5, 7.0, 0.5, None),
    ]
    return daily_summary(spark.createDataFrame(rows, TRIP_DDL), year=2021)


def read_csv(path):
    parts = glob.glob(f"{path}/part-*.csv")
    rows = []
    for p in parts:
        with open(p) as f:
            rows += list(csv.reader(f))
    return parts, rows


def test_small_csv_one_file_header(daily, tmp_path):
    desc = ["dt_year", "dt_month", "dt_day"]
    out = write_small_csv(daily, str(tmp_path / "daily_averages.csv"), [F.col(c).desc() for c in desc], max_rows=None)
    parts, rows = read_csv(out)
    assert len(parts) == 1
    assert rows[0][:4] == ["dt_year", "dt_month", "dt_day", "num_trips"]
    assert rows[1][:3] == ["2021", "6", "30"]  # newest first
    assert rows[2][-1] == ""  # all-NULL passenger mean written empty, integers stay integers
    assert rows[1][-1] == "2"


def test_small_csv_refuses_big(spark, tmp_path):
    with pytest.raises(ValueError):
        write_small_csv(spark.range(50), str(tmp_path / "x"), max_rows=10)


def test_small_csv_keeps_upstream_parallel(spark, tmp_path):
    counts = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    out = write_small_csv(counts, str(tmp_path / "k"), ["k"], max_rows=None)
    parts, rows = read_csv(out)
    assert len(parts) == 1 and [r[0] for r in rows[1:]] == [str(i) for i in range(7)]


def test_distributed_csv(spark, tmp_path):
    out = write_csv(spark.range(100).repartition(4), str(tmp_path / "d"))
    parts, rows = read_csv(out)
    assert len(parts) == 4 and len(rows) == 104


def test_output_names():
    assert output_names("cluster") == {
        "dataset_stats": "dataset_stats_cluster.csv",
        "top_subreddits": "top_subreddits_cluster.csv",
        "peak_hours": "peak_hours_cluster.csv",
    }
    with pytest.raises(ValueError):
        output_names("laptop")


def test_daily_report(daily):
    r = daily_report(daily, 5).collect()
    assert len(r) == 2
    assert r[0].day_label == "Year: 2021, Month: 06, Day: 30"
    assert r[0].trips == "Trips: 2"
    assert r[0].max_tax == "Max MTA Tax: $0.50"
    assert r[0].q95_fare == "95th Percentile Fare: $20.00"
    assert r[0].avg_passengers == "Avg Passengers: 2"
    assert r[0].text.splitlines()[1] == "  Trips: 2"


def test_overview_report(daily):
    r = overview_report(daily_overview(daily)).first()
    assert r.days_line == "Days with data: 2"
    assert r.range_line == "Date range: 2021-06-29 to 2021-06-30"
    assert r.component_line == "Date range (month/day min-max): 06/29/2021 to 06/30/2021"
    assert r.trips_line == "Total trips: 3"


def test_schema_profile(daily):
    prof = schema_profile(daily).collect()
    assert [(p.pos, p.column, p.type) for p in prof[:2]] == [(0, "dt_year", "int"), (1, "dt_month", "int")]


def test_to_pandas_guard(spark, daily):
    assert len(to_pandas(daily, max_rows=10)) == 2
    with pytest.raises(ValueError):
        to_pandas(spark.range(20), max_rows=10)


def test_sample_rows(spark):
    df = spark.range(100).repartition(7)
    assert [r.id for r in sample_rows(df, 5, ["id"]).collect()] == [0, 1, 2, 3, 4]


def test_sample_rows_sorts_one_column_first(spark, tmp_path):
    rows = [(i % 7, -i, f"t{i}") for i in range(60)] + [(None, 1, "n")]
    df = spark.createDataFrame(rows, "a int, b int, c string")
    for n in (0, 1, 5, 30, 100):
        assert sample_rows(df, n, ["a", "b"]).collect() == df.orderBy("a", "b").limit(n).collect()
    path = str(tmp_path / "p")
    df.write.parquet(path)
    plan = sample_rows(spark.read.parquet(path), 5, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual" in plan or "lessthanorequal" in plan.lower()
    assert sample_rows(df.where("false"), 3, ["a"]).collect() == []
