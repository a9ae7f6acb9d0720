"""Trees with one file per directory, each written by a task of its own."""

from __future__ import annotations

import datetime as dt
import glob
import re

import pytest
from pyspark.sql import functions as F

from daybook.plans import registry
from daybook.sinks.tree import by_directory, write_tree


def files(root):
    """Directory below the root -> the numbers of the tasks that wrote its files."""
    out = {}
    for f in glob.glob(f"{root}/**/*.parquet", recursive=True):
        directory, name = f[len(root) + 1 :].rsplit("/", 1)
        out.setdefault(directory, []).append(int(re.match(r"part-(\d+)", name)[1]))
    return out


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Forty months of trips and as many days of comments; a day twice, one without a date."""
    d = str(tmp_path_factory.mktemp("tables"))
    days = [dt.datetime(1995 + i // 12, i % 12 + 1, 1 + i % 28, 5) for i in range(40)] * 3 + [None, None]
    trips = spark.createDataFrame([(i % 100, t) for i, t in enumerate(days)], "l_orderkey bigint, l_shipdate timestamp_ntz")
    trips.repartition(5).write.parquet(f"{d}/lineitem.parquet")
    events = trips.select(F.col("l_orderkey").alias("event_id"), F.col("l_shipdate").alias("ts"))
    events.repartition(5).write.parquet(f"{d}/events.parquet")
    return d


@pytest.mark.parametrize(
    "made, table, ts, form", [
        (registry.monthly_trips, "lineitem", "l_shipdate", "yyyy={0:%Y}/mm={0:%m}"),
        (registry.daily_comments, "events", "ts", "mm={0:%m}/dd={0:%d}"),
    ]
)
def test_a_directory_is_one_file_of_its_own_task(spark, tables, made, table, ts, form):
    root = made(spark, tables).removeprefix("file:")
    rows = spark.read.parquet(f"{tables}/{table}.parquet").collect()
    none = "/".join(f"{p.split('=')[0]}=__HIVE_DEFAULT_PARTITION__" for p in form.split("/"))
    wanted = {form.format(r[ts]) if r[ts] else none for r in rows}
    got = files(root)
    assert set(got) == wanted and len(wanted) == 41
    assert sorted(n for tasks in got.values() for n in tasks) == list(range(41))  # one file each, no task twice
    back = spark.read.schema(spark.read.parquet(f"{tables}/{table}.parquet").schema).parquet(root)
    assert sorted(map(repr, back.drop("yyyy", "mm", "dd").collect())) == sorted(map(repr, rows))


def test_empty_tables_and_odd_names(spark, tmp_path):
    empty = str(tmp_path / "e")
    write_tree(spark.range(0), empty, {"k": F.lit("x")})
    assert files(empty) == {}
    df = spark.createDataFrame([(i % 3, None if i % 3 == 2 else float(i % 3)) for i in range(30)], "`a b` int, x double")
    parts = by_directory(df, ["a b", "x"]).rdd.glom().collect()
    assert sorted(len(p) for p in parts) == [10, 10, 10] and all(len(set(p)) == 1 for p in parts)
    assert by_directory(df.where("false"), ["x"]).collect() == []
