"""Footers, listings and the file index read by executors (FIXTURES.md §5 layouts in temp folders)."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.sources import index_files, list_tree, read_footers, read_months, read_period, refreshed, tree_sizes

UTC = dt.timezone.utc


def micros(y, m=1, d=1):
    return int(dt.datetime(y, m, d, tzinfo=UTC).timestamp()) * 1_000_000


def day_rows(year, month, n=28):
    return [(dt.datetime(year, month, 1 + i % 28, i % 24), float(i)) for i in range(n)]


@pytest.fixture(autouse=True, scope="module")
def statistics(spark):
    """Timestamps as INT64, which carry statistics; Spark's default is INT96."""
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    yield
    spark.conf.unset("spark.sql.parquet.outputTimestampType")


@pytest.fixture(scope="module")
def months(spark, tmp_path_factory):
    """Two years of monthly files in one tree."""
    root = str(tmp_path_factory.mktemp("idx") / "trips")
    rows = [(*r, y, m) for y in (2020, 2021) for m in range(1, 13) for r in day_rows(y, m)]
    df = spark.createDataFrame(rows, "ts timestamp, x double, yyyy int, mm int")
    df.repartition(24, "yyyy", "mm").write.partitionBy("yyyy", "mm").parquet(root)
    return root


def test_footer_rows(spark, tmp_path):
    a, b, c = (str(tmp_path / n) for n in ("a", "b", "c"))
    spark.createDataFrame(day_rows(2021, 3), "ts timestamp, x double").coalesce(1).write.parquet(a)
    spark.createDataFrame([(None, 1.0)], "ts timestamp, x double").coalesce(1).write.parquet(b)
    spark.createDataFrame([(dt.date(1965, 2, 3), "q")], "ts date, note string").coalesce(1).write.parquet(c)
    files = {n: f"{d}/{f}" for n, d in (("a", a), ("b", b), ("c", c)) for f in os.listdir(d) if f.endswith(".parquet")}
    bad = tmp_path / "bad.parquet"
    bad.write_bytes(b"PAR1 damaged")
    missing = str(tmp_path / "none.parquet")
    rows = {r.path: r for r in read_footers(spark, [*files.values(), str(bad), missing], "ts").collect()}
    one = rows[files["a"]]
    assert (one.status, one.rows, one.columns) == ("ok", 28, ["ts", "x"])
    assert one.low == micros(2021, 3) and one.high > micros(2021, 3, 28)
    assert rows[files["b"]].signature == one.signature and rows[files["b"]].low is None
    assert rows[files["c"]].signature != one.signature and rows[files["c"]].low == micros(1965, 2, 3)
    assert rows[str(bad)].status == "failed" and rows[missing].error.startswith("FileNotFoundError")
    assert read_footers(spark, []).collect() == []


def test_listing_of_a_tree(spark, tmp_path):
    root = tmp_path / "tree"
    want = {}
    for i in range(60):
        d = root / f"yyyy={2000 + i % 6}" / f"mm={i % 12:02d}" / f"n={i}"
        d.mkdir(parents=True)
        (d / "part.bin").write_bytes(b"x" * i)
        want[str(d)] = (1, i)
    (root / "_SUCCESS").write_bytes(b"")
    (root / ".hidden").mkdir()
    (root / "empty").mkdir()
    missing = str(tmp_path / "none")
    single = str(root / "yyyy=2000" / "mm=00" / "n=0" / "part.bin")
    tree = list_tree(spark, [str(root), missing, single])
    rows = tree.collect()
    assert {(r.root, r.status) for r in rows if r.status != "ok"} == {(missing, "not_found")}
    assert len([r for r in rows if r.root == str(root)]) == 60 and [r.path for r in rows if r.root == single] == [single]
    sizes = {r.directory: (r.n_files, r.total_bytes) for r in tree_sizes(tree).where(F.col("root") == str(root)).collect()}
    assert sizes == want
    uri = list_tree(spark, [f"file://{root}"]).collect()
    assert all(r.path.startswith(f"file://{root}/yyyy=") for r in uri) and len(uri) == 60
    with pytest.raises(ValueError, match="tasks can't list"):
        list_tree(spark, ["viewfs://x/y"])
    assert list_tree(spark, []).collect() == []


def small_files(spark, tmp_path):
    """Drift, a damaged file, an empty directory and a hive tree; returns paths to load."""
    a, b, tree, bad, empty = (str(tmp_path / n) for n in ("a", "b", "tree", "bad.parquet", "empty"))
    spark.range(40).select(F.col("id").cast("int").alias("id")).repartition(8).write.parquet(a)
    spark.range(40, 80).selectExpr("id", "'n' AS note").repartition(4).write.parquet(b)
    spark.range(30).selectExpr("id", "id % 3 AS k").write.partitionBy("k").parquet(tree)
    (tmp_path / "bad.parquet").write_bytes(b"not parquet at all")
    (tmp_path / "a" / "part-zz.parquet").write_bytes(b"PAR1 damaged")
    os.mkdir(empty)
    return [a, b, tree, bad, empty, str(tmp_path / "none")]


def test_footers_by_executors_give_what_the_driver_gives(spark, tmp_path):
    paths = small_files(spark, tmp_path)
    declared = T.StructType([T.StructField("id", T.LongType()), T.StructField("note", T.StringType()), T.StructField("k", T.LongType())])
    for schema in (None, declared):
        got = [read_months(spark, paths, schema=schema, few=few) for few in (10_000, 0)]
        one, two = got
        # Spark's listing spells a file as a URI, the tasks' as the caller spelled its root.
        strip = lambda xs: sorted((p.removeprefix("file:").replace("///", "/"), c) for p, c in xs)
        assert one.read == two.read and strip(one.skipped) == strip(two.skipped) and strip(one.filled) == strip(two.filled)
        rows = [sorted(map(repr, x.df.select(sorted(x.df.columns)).collect())) for x in got]
        assert rows[0] == rows[1] and len(rows[0]) == 110
    assert {w for _, w in one.skipped} == {"unexpected", "analysis_error", "not_found"}
    with pytest.raises(Exception):
        read_months(spark, paths, few=0, tolerant=False)


def test_many_small_files_need_no_driver_call_each(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "many")
    spark.range(600).repartition(300).write.parquet(root)
    from pyspark.sql import DataFrameReader

    calls = []
    read = DataFrameReader.parquet
    monkeypatch.setattr(DataFrameReader, "parquet", lambda self, *p, **o: calls.append(p) or read(self, *p, **o))
    loaded = read_months(spark, [root])
    assert loaded.df.count() == 600 and loaded.skipped == []
    assert len(calls) == 2  # one schema for the one kind of footer, one scan


def test_index_reads_only_the_months_asked_for(spark, months):
    index = index_files(spark, [months], "ts")
    assert index.count() == 24
    got = read_period(spark, index, "ts", 2021, (2, 4))
    assert (got.files_read, got.files_total) == (3, 24)
    assert got.df.count() == 84 and set(got.df.columns) == {"ts", "x", "yyyy", "mm"}
    assert {r.mm for r in got.df.select("mm").distinct().collect()} == {2, 3, 4}
    files = got.df.inputFiles()
    assert len(files) == 3 and all("yyyy=2021" in f for f in files)
    assert read_period(spark, index, "ts", 2020).files_read == 12
    with pytest.raises(FileNotFoundError):
        read_period(spark, index, "ts", 1999)


def test_files_whose_footers_do_not_tell(spark, tmp_path):
    root = str(tmp_path / "t r+%41")
    spark.conf.set("spark.sql.parquet.outputTimestampType", "INT96")  # no statistics for these
    for m in (5, 7):
        spark.createDataFrame(day_rows(2021, m), "ts timestamp, x double").coalesce(1).write.parquet(f"{root}/m={m}")
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    spark.createDataFrame(day_rows(2021, 6), "ts timestamp, x double").coalesce(1).write.parquet(f"{root}/m=6")
    spark.createDataFrame([(1.0,)], "x double").coalesce(1).write.parquet(f"{root}/m=8")
    index = index_files(spark, [root], "ts")
    schema = T.StructType([T.StructField("ts", T.TimestampType()), T.StructField("x", T.DoubleType())])
    rows = {r.path.split("/m=")[1][0]: r for r in index.collect()}
    assert rows["5"].low == micros(2021, 5) and rows["8"].low is None
    assert read_period(spark, index, "ts", 2021, (6, 6), schema).files_read == 2  # m=8 does not tell
    got = read_period(spark, index, "ts", 2021, (5, 5), schema)
    assert got.df.count() == 28 and got.files_read == 2
    from daybook.sources.index import listed, with_footers

    unscanned = with_footers(spark, listed(spark, [root]), "ts", scan=False)
    assert read_period(spark, unscanned, "ts", 2021, (6, 6), schema).files_read == 4


def test_index_refresh_reads_new_and_changed_files_only(spark, tmp_path):
    root = str(tmp_path / "t")
    write = lambda m, n=28: spark.createDataFrame(day_rows(2021, m, n), "ts timestamp, x double").coalesce(1).write.mode("overwrite").parquet(f"{root}/mm={m}")
    write(1), write(2)
    old = index_files(spark, [root], "ts").withColumn("error", F.lit("kept"))
    write(2, 5), write(3)
    new = refreshed(spark, old, [root], "ts")
    assert sorted(((r.rows, r.error) for r in new.collect()), key=repr) == [(28, "kept"), (28, None), (5, None)]
    assert read_period(spark, new, "ts", 2021).df.count() == 61
