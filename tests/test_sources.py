"""Sources on file layouts written into a temp directory (FIXTURES.md §5)."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.operators.daily import daily_summary
from daybook.sources import (
    TRIP_SCHEMA,
    check_options,
    classify_error,
    input_size,
    list_directory,
    list_files,
    month_paths,
    probe_sources,
    read_leaf,
    read_months,
    read_parquet,
    read_partitioned,
    stage,
)

TRIP_DDL = (
    "tpep_pickup_datetime timestamp, trip_distance double, mta_tax double, "
    "fare_amount double, tip_amount double, passenger_count double"
)


def month_rows(month: int, n: int = 30):
    return [
        (dt.datetime(2021, month, 1 + i % 28, i % 24), float(i), 0.5, float(10 + i), float(i % 3), float(1 + i % 4))
        for i in range(n)
    ]


@pytest.fixture(scope="module")
def monthly(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tlc"))
    for m in range(1, 7):
        spark.createDataFrame(month_rows(m), TRIP_DDL).coalesce(1).write.parquet(
            month_paths(root, 2021, [m])[0]
        )
    return root


def test_month_paths():
    assert month_paths("s3a://b/x/", 2021, [1, 12]) == [
        "s3a://b/x/yyyy=2021/yellow_tripdata_2021-01.parquet",
        "s3a://b/x/yyyy=2021/yellow_tripdata_2021-12.parquet",
    ]
    with pytest.raises(ValueError):
        month_paths("r", 2021, [13])


def test_multi_file_equals_single(spark, monthly, tmp_path):
    loaded = read_months(spark, month_paths(monthly, 2021, range(1, 7)))
    assert loaded.skipped == [] and len(loaded.read) == 6
    single = str(tmp_path / "one.parquet")
    loaded.df.coalesce(1).write.parquet(single)
    a = daily_summary(loaded.df, year=2021, mean_digits=6).collect()
    b = daily_summary(spark.read.parquet(single), year=2021, mean_digits=6).collect()
    assert a == b and sum(r.num_trips for r in a) == 180


def test_glob_and_month_subset(spark, monthly):
    glob = read_parquet(spark, f"{monthly}/yyyy=2021/*.parquet")
    assert glob.count() == 180
    sub = read_months(spark, month_paths(monthly, 2021, [1, 2, 3])).df
    assert sub.count() == 90
    assert glob.where(F.month("tpep_pickup_datetime").isin(1, 2, 3)).count() == 90


def test_tolerant_missing_month(spark, monthly):
    paths = month_paths(monthly, 2021, range(1, 8))  # month 7 does not exist
    loaded = read_months(spark, paths)
    assert loaded.skipped == [(paths[6], "not_found")]
    assert loaded.df.count() == 180
    with pytest.raises(AnalysisException) as err:
        spark.read.parquet(*paths)
    assert classify_error(err.value) == "not_found"
    with pytest.raises(AnalysisException):
        read_months(spark, paths, tolerant=False)


def test_no_months_raises(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_months(spark, month_paths(str(tmp_path), 2021, [1, 2]))


def test_schema_drift(spark, tmp_path):
    a, b = str(tmp_path / "m1.parquet"), str(tmp_path / "m2.parquet")
    spark.createDataFrame([(1, 1.5)], "id int, x double").write.parquet(a)
    spark.createDataFrame([(2**40, 2.5, "extra")], "id bigint, x double, note string").write.parquet(b)
    with pytest.raises(Exception):
        spark.read.parquet(a, b).collect()  # INT vs BIGINT fails at run time
    declared = T.StructType([T.StructField("id", T.LongType()), T.StructField("x", T.DoubleType())])
    got = read_months(spark, [a, b], schema=declared).df
    assert got.dtypes == [("id", "bigint"), ("x", "double")]
    assert sorted(r.id for r in got.collect()) == [1, 2**40]
    loose = read_months(spark, [a, b]).df
    assert sorted(loose.columns) == ["id", "note", "x"] and loose.count() == 2


def test_declared_trip_schema(spark, monthly):
    got = read_months(spark, month_paths(monthly, 2021, [1]), schema=TRIP_SCHEMA).df
    assert [f.name for f in got.schema.fields] == [f.name for f in TRIP_SCHEMA.fields]


@pytest.fixture(scope="module")
def hive_tree(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("reddit") / "comments")
    rows = [(f"c{i}", f"u{i % 7}", f"s{i % 3}", "text", 1704067200 + i * 3600, 2024, 1 + i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "id string, author string, subreddit string, body string, created_utc bigint, yyyy int, mm int")
    df.write.partitionBy("yyyy", "mm").parquet(root)
    return root


def test_partition_columns_and_pruning(spark, hive_tree):
    full = read_partitioned(spark, hive_tree)
    assert {"yyyy", "mm"} <= set(full.columns)
    jan = read_partitioned(spark, hive_tree, {"yyyy": 2024, "mm": 1})
    assert jan.count() == 20
    plan = jan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(yyyy" in plan and "(mm#" in plan
    leaf = spark.read.parquet(f"{hive_tree}/yyyy=2024/mm=1")
    assert "mm" not in leaf.columns
    kept = read_leaf(spark, hive_tree, f"{hive_tree}/yyyy=2024/mm=1")
    assert {"yyyy", "mm"} <= set(kept.columns) and kept.count() == 20


def test_stage(spark, hive_tree, tmp_path):
    dst = str(tmp_path / "staged")
    got = stage(spark, hive_tree, dst, {"yyyy": 2024, "mm": 2})
    assert got.count() == 20
    assert os.path.isdir(f"{dst}/yyyy=2024/mm=2") and not os.path.exists(f"{dst}/yyyy=2024/mm=1")
    stage(spark, hive_tree, dst, {"yyyy": 2024, "mm": 1})  # other partition kept
    assert read_partitioned(spark, dst).count() == 40
    stage(spark, hive_tree, dst, {"yyyy": 2024, "mm": 2})  # rerun rewrites, no duplicates
    assert read_partitioned(spark, dst).count() == 40


def test_file_listing(spark, tmp_path):
    d = tmp_path / "files"
    d.mkdir()
    for i in range(12):
        (d / f"part-{i:02d}.bin").write_bytes(b"x" * (100 + i))
    files = list_files(spark, str(d))
    assert files.count() == 12
    assert sorted(r.name for r in files.collect())[:2] == ["part-00.bin", "part-01.bin"]
    size = input_size(files).first()
    assert size.n_files == 12 and size.total_bytes == sum(100 + i for i in range(12))
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema:")[1].split("\n")[0]
    assert list_files(spark, str(d), glob="part-0*.bin").count() == 10


def test_probe(spark, monthly, tmp_path):
    missing = str(tmp_path / "nope")
    good = month_paths(monthly, 2021, [1])[0]
    rows = probe_sources(spark, [missing, good, good]).collect()
    assert [r.status for r in rows] == ["not_found", "ok"]
    assert rows[1].rows == 30 and rows[1].n_columns == 6
    assert rows[1].schema_ddl.startswith("struct<tpep_pickup_datetime:timestamp")


def test_error_labels():
    class Fake(Exception):
        pass

    assert classify_error(Fake("com.amazonaws...: NoSuchBucket")) == "no_bucket"
    assert classify_error(Fake("Status Code: 403; Error Code: AccessDenied")) == "access_denied"
    assert classify_error(Fake("boom")) == "unexpected"


def test_unknown_option(spark, monthly):
    with pytest.raises(ValueError, match="header"):
        read_parquet(spark, month_paths(monthly, 2021, [1])[0], header=True)
    assert check_options({"mergeSchema": False}) == {"mergeSchema": "false"}
    month_dir = month_paths(monthly, 2021, [1])[0]  # a directory of part files
    assert read_parquet(spark, month_dir, pathGlobFilter="part-*.parquet").count() == 30


def test_tolerant_of_anything_unreadable(spark, tmp_path):
    good, bad, mixed = (str(tmp_path / n) for n in ("good", "bad.parquet", "mixed"))
    spark.range(5).write.parquet(good)
    (tmp_path / "bad.parquet").write_bytes(b"not parquet at all")
    spark.range(3).coalesce(1).write.parquet(mixed)
    (tmp_path / "mixed" / "part-zz.parquet").write_bytes(b"PAR1 damaged")
    loaded = read_months(spark, [good, bad, mixed, str(tmp_path / "none")])
    assert loaded.df.count() == 8 and loaded.read == [good, mixed]
    assert [(os.path.basename(p), why) for p, why in loaded.skipped] == [("bad.parquet", "unexpected"), ("part-zz.parquet", "unexpected"), ("none", "not_found")]
    with pytest.raises(Exception):
        read_months(spark, [good, bad], tolerant=False)
    with pytest.raises(FileNotFoundError):
        read_months(spark, [bad])


def test_drift_inside_one_directory(spark, tmp_path):
    d = str(tmp_path / "month=1")
    spark.createDataFrame([(1, 1.5)], "id int, x double").coalesce(1).write.parquet(d)
    spark.createDataFrame([(2**40, "n")], "id bigint, note string").coalesce(1).write.mode("append").parquet(d)
    loaded = read_months(spark, [d])
    assert sorted((r.id, r.x, r.note) for r in loaded.df.collect()) == [(1, 1.5, None), (2**40, None, "n")]


def test_declared_columns_that_are_missing(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    spark.createDataFrame([(1, 1.5)], "id int, x double").coalesce(1).write.parquet(a)
    spark.createDataFrame([(2,)], "id int").coalesce(1).write.parquet(b)
    declared = T.StructType([T.StructField("id", T.LongType()), T.StructField("x", T.DoubleType())])
    loaded = read_months(spark, [a, b], schema=declared)
    assert loaded.filled == [(b, "x")] and sorted((r.id, r.x) for r in loaded.df.collect()) == [(1, 1.5), (2, None)]
    misspelled = T.StructType([*declared.fields, T.StructField("fair_amount", T.DoubleType())])
    with pytest.raises(ValueError, match="fair_amount"):
        read_months(spark, [a, b], schema=misspelled)


def test_partition_columns_of_a_directory_stay(spark, hive_tree):
    loaded = read_months(spark, [hive_tree])
    assert loaded.df.where("yyyy = 2024 and mm = 1").count() == 20


def test_staging_keeps_directory_names(spark, tmp_path):
    src, dst = str(tmp_path / "src"), str(tmp_path / "dst")
    df = spark.createDataFrame([("c1", "2024", "01"), ("c2", "2024", "02"), ("c+3", "2024", "10")], "id string, yyyy string, mm string")
    df.write.partitionBy("yyyy", "mm").parquet(src)
    assert os.path.isdir(f"{src}/yyyy=2024/mm=01")
    got = stage(spark, src, dst, {"yyyy": 2024, "mm": 1})
    assert [r.id for r in got.collect()] == ["c1"]
    assert [r.id for r in spark.read.parquet(f"{dst}/yyyy=2024/mm=01").collect()] == ["c1"]
    assert stage(spark, src, str(tmp_path / "none"), {"yyyy": 2024, "mm": 7}).collect() == []
    assert not os.path.exists(tmp_path / "none")


def test_directory_listing(spark, tmp_path):
    for i in range(13):
        (tmp_path / f"f{i:02d}.bin").write_bytes(b"x")
    found = list_directory(spark, str(tmp_path))
    assert (found.exists, found.names, found.rest) == (True, [f"f{i:02d}.bin" for i in range(10)], 3)
    missing = list_directory(spark, str(tmp_path / "nope"))
    assert (missing.exists, missing.names, missing.rest) == (False, [], 0)


def test_probe_errors_are_whole(spark, tmp_path):
    (tmp_path / "bad.parquet").write_bytes(b"not parquet at all")
    row = probe_sources(spark, [str(tmp_path / "bad.parquet")]).first()
    assert row.status == "unexpected" and "bad.parquet" in row.error


def test_option_names_in_any_case():
    assert check_options({"mergeschema": True}) == {"mergeschema": "true"}
