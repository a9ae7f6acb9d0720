"""Copies with a manifest, and results in total order over many files."""

from __future__ import annotations

import os
import shutil

import pytest
from pyspark.sql import functions as F

from daybook.sinks.ordered import in_ranges, positions, write_sorted_csv
from daybook.sources.copies import copy_new, manifest, read_copy


@pytest.fixture
def tree(spark, tmp_path):
    root = str(tmp_path / "src")
    df = spark.range(120).selectExpr("id", "concat('t', id) AS t", "'2024' AS yyyy", "lpad(CAST(id % 4 + 1 AS string), 2, '0') AS mm")
    df.repartition(4, "mm").write.partitionBy("yyyy", "mm").parquet(root)
    return root


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_rerun_copies_nothing(spark, tree, tmp_path):
    dst = str(tmp_path / "dst")
    first = copy_new(spark, tree, dst)
    assert (len(first.partitions), first.files, first.rows) == (4, 4, 120)
    assert first.partitions[0] == "yyyy=2024/mm=01"
    second = copy_new(spark, tree, dst)
    assert (second.partitions, second.files, second.files_total) == ([], 0, 4)
    got = read_copy(spark, dst)
    assert ids(got) == list(range(120)) and set(got.columns) == {"id", "t", "yyyy", "mm"}
    assert ids(read_copy(spark, dst, {"mm": 2})) == list(range(1, 120, 4))
    rows = manifest(spark, dst).rows().collect()
    assert sorted((r.part, r.rows) for r in rows) == [(f"yyyy=2024/mm=0{m}", 30) for m in range(1, 5)]


def test_only_new_and_changed_partitions_are_copied(spark, tree, tmp_path):
    dst = str(tmp_path / "dst")
    copy_new(spark, tree, dst, where={"mm": 1})
    assert ids(read_copy(spark, dst)) == list(range(0, 120, 4))
    assert len(copy_new(spark, tree, dst).partitions) == 3
    spark.range(500, 503).selectExpr("id", "'new' AS t").coalesce(1).write.mode("append").parquet(f"{tree}/yyyy=2024/mm=02")
    more = copy_new(spark, tree, dst)
    assert more.partitions == ["yyyy=2024/mm=02"] and more.rows == 33
    assert ids(read_copy(spark, dst)) == sorted([*range(120), 500, 501, 502])
    # A file that is gone from the source is gone from the copy.
    part = f"{tree}/yyyy=2024/mm=03"
    spark.range(900, 902).selectExpr("id", "'x' AS t").coalesce(1).write.mode("overwrite").parquet(part)
    assert copy_new(spark, tree, dst).partitions == ["yyyy=2024/mm=03"]
    assert ids(read_copy(spark, dst, {"mm": 3})) == [900, 901]


def test_a_copy_that_differs_or_dies_is_not_seen(spark, tree, tmp_path, monkeypatch):
    dst = str(tmp_path / "dst")
    with pytest.raises(FileNotFoundError):
        read_copy(spark, dst)
    copy_new(spark, tree, dst, where={"mm": 1})
    from daybook.sources import copies

    counts = copies._counts
    monkeypatch.setattr(copies, "_counts", lambda df: counts(df.limit(20)))
    with pytest.raises(RuntimeError, match="nothing published"):
        copy_new(spark, tree, dst)
    monkeypatch.undo()
    # A run's folder without its row in the manifest, as a killed run leaves it.
    runs = [d for d in os.listdir(dst) if d.startswith("run=")]
    assert len(runs) == 2 and ids(read_copy(spark, dst)) == list(range(0, 120, 4))
    shutil.copytree(f"{dst}/{runs[0]}", f"{dst}/run=half")
    assert ids(read_copy(spark, dst)) == list(range(0, 120, 4))
    assert len(copy_new(spark, tree, dst).partitions) == 3 and ids(read_copy(spark, dst)) == list(range(120))


def test_counts_that_miss_the_same_rows_on_both_sides(spark, tree, tmp_path, monkeypatch):
    from daybook.sources import copies

    dst, counts = str(tmp_path / "dst"), copies._counts
    monkeypatch.setattr(copies, "_counts", lambda df: counts(df.limit(20)))
    with pytest.raises(RuntimeError, match="20 rows counted by file, 30 in all: nothing published"):
        copy_new(spark, tree, dst, where={"mm": 1})  # one partition: both limits fall on it
    with pytest.raises(FileNotFoundError):
        read_copy(spark, dst)


def test_partitions_without_rows(spark, tmp_path):
    src, dst = str(tmp_path / "s"), str(tmp_path / "d")
    spark.range(3).selectExpr("id").write.parquet(f"{src}/yyyy=2024/mm=01")
    spark.range(0).selectExpr("id").coalesce(1).write.parquet(f"{src}/yyyy=2024/mm=02")
    copy_new(spark, src, dst)
    assert ids(read_copy(spark, dst)) == [0, 1, 2] and copy_new(spark, src, dst).partitions == []


def read_parts(spark, path):
    """Rows in the order of the parts' names and lines."""
    out = []
    for name in sorted(f for f in os.listdir(path) if f.endswith(".csv")):
        with open(os.path.join(path, name)) as f:
            out += [tuple(line.rstrip("\n").split(",")) for line in list(f)[1:]]
    return out


def test_sorted_parts_hold_the_whole_order(spark, tmp_path):
    df = spark.range(5000).selectExpr("id % 700 AS a", "id AS b").repartition(5)
    path = str(tmp_path / "out")
    files = write_sorted_csv(df, path, [F.col("a").desc(), F.col("b")], rows_per_file=600)
    assert files == 9
    got = [(int(a), int(b)) for a, b in read_parts(spark, path)]
    assert got == sorted(((i % 700, i) for i in range(5000)), key=lambda r: (-r[0], r[1]))
    placed = positions(spark.read.option("header", True).schema("a bigint, b bigint").csv(path)).collect()
    assert [(r.a, r.b) for r in sorted(placed, key=lambda r: r.position)] == got
    assert sorted(r.position for r in placed) == list(range(1, 5001))


def test_a_key_of_a_third_of_all_rows_fills_several_files(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.lit("same").alias("x")).repartition(6)
    sizes = [len(p) for p in in_ranges(df, [F.col("k")], 10).rdd.glom().map(lambda rs: [r.k for r in rs]).collect()]
    assert len(sizes) == 10 and max(sizes) < 3 * 30_000 / 10
    parts = in_ranges(df, [F.col("k")], 10).rdd.glom().map(lambda rs: [r.k for r in rs]).collect()
    flat = [k for p in parts for k in p]
    assert flat == sorted(flat) and len(flat) == 30_000


def test_small_and_empty_results_in_order(spark, tmp_path):
    assert write_sorted_csv(spark.range(3).toDF("b"), str(tmp_path / "a"), [F.col("b").desc()]) == 1
    assert [b for (b,) in read_parts(spark, str(tmp_path / "a"))] == ["2", "1", "0"]
    assert write_sorted_csv(spark.range(0).toDF("b"), str(tmp_path / "e"), [F.col("b")]) == 1
    with pytest.raises(ValueError):
        in_ranges(spark.range(1), [], 1)
