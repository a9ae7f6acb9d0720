"""The installation-check operations (FIXTURES.md §1 'sequence')."""

from __future__ import annotations

import pytest

from daybook.operators.basic import even_double, first_value, row_count, sequence, sql_count


def test_range(spark):
    df = sequence(spark, 1000)
    assert df.dtypes == [("id", "bigint")]
    assert row_count(df).first().total_rows == 1000


def test_sql_count(spark):
    total = sql_count(sequence(spark, 1000), "test_table")
    assert total.columns == ["total"]
    assert first_value(total, "total") == 1000


def test_even_double(spark):
    out = even_double(sequence(spark, 1000))
    assert out.columns == ["id2"]
    vals = [r.id2 for r in out.collect()]
    assert len(vals) == 500 and vals[:3] == [0, 4, 8]


def test_bad_view_name(spark):
    with pytest.raises(ValueError):
        sql_count(sequence(spark, 3), "x; DROP")


def test_first_value_empty(spark):
    assert first_value(sequence(spark, 0), "id") is None


def test_conf_passed_through(spark):
    from daybook import session

    s = session.build("again", {"spark.hadoop.fs.s3a.endpoint": "http://example.invalid"})
    assert s is spark or s.sparkContext is spark.sparkContext
    assert s.conf.get("spark.hadoop.fs.s3a.endpoint") == "http://example.invalid"
    assert s.conf.get("spark.sql.execution.arrow.pyspark.enabled") == "true"


def test_scale_settings():
    from daybook.session import GB, MB, scale_settings

    big = scale_settings(100_000 * GB, 8000)
    assert big["spark.sql.files.maxPartitionBytes"] == str(512 * MB)
    # 1 GB a reduce task at every input size.
    assert big["spark.sql.shuffle.partitions"] == "100000"
    assert big["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == "100000"
    assert scale_settings(5_000 * GB, 1000)["spark.sql.shuffle.partitions"] == "5000"
    small = scale_settings(80 * MB, 8)
    # Small input: at least one split per core, two shuffle partitions per core.
    assert small["spark.sql.files.maxPartitionBytes"] == str(10 * MB)
    assert small["spark.sql.shuffle.partitions"] == "16"
