"""Exact percentile: brute force on small fixtures, including the narrowing path."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from daybook.operators.percentile import band, exact_percentile, rank_target


def brute(values, p):
    vals = sorted(v for v in values if v is not None)
    if not vals:
        return None
    from decimal import Decimal

    r = max(1, math.ceil(Decimal(repr(p)) * len(vals)))
    return vals[r - 1]


@pytest.mark.parametrize("p", [0.0, 0.07, 0.5, 0.95, 1.0])
def test_small_groups(spark, p):
    rnd = random.Random(7)
    rows = [(k, float(rnd.randint(0, 500))) for k in range(5) for _ in range(rnd.randint(1, 300))]
    rows += [(9, None)]
    df = spark.createDataFrame(rows, "k int, v double")
    got = {r.k: r.q for r in exact_percentile(df, ["k"], "v", p, "q").collect()}
    want = {k: brute([v for kk, v in rows if kk == k], p) for k in range(5)}
    assert got == want  # group 9 (all NULL) yields no row


@pytest.mark.parametrize("p", [0.05, 0.5, 0.95])
@pytest.mark.parametrize("options", [{"accuracy": 100}, {"accuracy": 100, "broadcast_rows": 0}, {"accuracy": 5, "window_values": 0}, {}])
def test_hot_group(spark, p, options):
    # One key holds most rows; coarse sketches, and bands joined by a salted shuffle.
    rnd = random.Random(11)
    hot = [(0, float(rnd.randint(0, 5000))) for _ in range(30_000)]
    cold = [(k, float(rnd.randint(0, 50))) for k in range(1, 40) for _ in range(20)]
    rows = hot + cold
    df = spark.createDataFrame(rows, "k int, v double").repartition(6)
    got = {r.k: r.q for r in exact_percentile(df, ["k"], "v", p, "q", **options).collect()}
    assert len(got) == 40
    for k in got:
        assert got[k] == brute([v for kk, v in rows if kk == k], p), k


def test_duplicates_across_band(spark):
    rows = [(0, 1.0)] * 5000 + [(0, 2.0)] * 5000 + [(0, 3.0)] * 10
    df = spark.createDataFrame(rows, "k int, v double")
    values = [v for _, v in rows]
    for p in (0.3, 0.4995, 0.5, 0.9, 0.9995, 1.0):
        got = exact_percentile(df, ["k"], "v", p, "q", accuracy=50).first().q
        assert got == brute(values, p), p


def test_matches_percentile_disc(spark, sf001):
    li = spark.read.parquet(f"{sf001}/lineitem.parquet").withColumn("y", F.year("l_shipdate"))
    ours = exact_percentile(li, ["y"], "l_extendedprice", 0.95, "q").orderBy("y").collect()
    li.createOrReplaceTempView("li_pct")
    sql = spark.sql(
        "SELECT y, percentile_disc(0.95) WITHIN GROUP (ORDER BY l_extendedprice) AS q FROM li_pct GROUP BY y ORDER BY y"
    ).collect()
    assert [(r.y, r.q) for r in ours] == [(r.y, r.q) for r in sql]


def test_every_group_large(spark):
    rnd = random.Random(5)
    rows = [(k, float(rnd.randint(0, 3000))) for k in range(4) for _ in range(2000 + 500 * k)]
    df = spark.createDataFrame(rows, "k int, v double").repartition(4)
    for p in (0.5, 0.95):
        got = {r.k: r.q for r in exact_percentile(df, ["k"], "v", p, "q", accuracy=200).collect()}
        assert got == {k: brute([v for kk, v in rows if kk == k], p) for k in range(4)}, p


def test_given_bands_with_empty_group(spark):
    # Bands from a caller's aggregate may list a group whose values are all NULL.
    rnd = random.Random(3)
    rows = [(k, float(rnd.randint(0, 900))) for k in range(3) for _ in range(1500)] + [(7, None)] * 5
    df = spark.createDataFrame(rows, "k int, v double")
    bands = df.groupBy("k").agg(*band("v", 0.9, 100)).checkpoint()
    got = {r.k: r.q for r in exact_percentile(df, ["k"], "v", 0.9, "q", accuracy=100, bands=bands).collect()}
    assert got == {k: brute([v for kk, v in rows if kk == k], 0.9) for k in range(3)}


@pytest.mark.parametrize("options", [{}, {"accuracy": 10}, {"broadcast_rows": 0, "window_values": 0}, {"accuracy": 10, "broadcast_rows": 0}])
def test_null_keys_are_a_group(spark, options):
    rnd = random.Random(13)
    keys = [(1, "a"), (1, None), (None, "a"), (None, None)]
    rows = [(*keys[0 if i % 5 else i // 5 % 4], float(rnd.randint(0, 4000))) for i in range(6000)]
    rows += [(None, None, float(i)) for i in range(9000)]  # a large NULL group
    df = spark.createDataFrame(rows, "k int, g string, v double").repartition(5)
    got = {(r.k, r.g): r.q for r in exact_percentile(df, ["k", "g"], "v", 0.95, "q", **options).collect()}
    assert got == {key: brute([v for k, g, v in rows if (k, g) == key], 0.95) for key in keys}


def test_a_band_that_misses_is_widened(spark):
    rows = [(k, float(i)) for k in (0, None) for i in range(1000)] + [(7, 5.0)]
    df = spark.createDataFrame(rows, "k int, v double")
    for lo, hi in ((0.0, 1.0), (998.0, 999.0), (2000.0, 3000.0), (500.2, 500.3)):
        bands = df.groupBy("k").agg(F.count("v").alias("_n"), F.lit(lo).alias("_lo"), F.lit(hi).alias("_hi")).checkpoint()
        for most in (0, 10_000):
            got = {r.k: r.q for r in exact_percentile(df, ["k"], "v", 0.5, "q", bands=bands, window_values=most).collect()}
            assert got == {0: 499.0, None: 499.0, 7: 5.0}, (lo, hi)


def test_nan_sorts_last_and_whole_table(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (2.0,), (None,)], "v double")
    assert [r.q for r in exact_percentile(df, [], "v", 0.5, "q").collect()] == [2.0]
    assert math.isnan(exact_percentile(df, [], "v", 1.0, "q").first().q)
    assert exact_percentile(df.where("false"), [], "v", 0.5, "q").collect() == []


def test_too_many_decimals_are_refused():
    with pytest.raises(ValueError, match="decimals"):
        rank_target(0.12345678901, F.lit(1))


def test_reads_of_the_input(spark, tmp_path):
    """Two reads for groups of any size (three if a band misses)."""
    path = str(tmp_path / "t")
    spark.range(20_000).selectExpr("if(id % 3 = 0, null, id % 2) k", "cast(id as double) v").write.parquet(path)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("percentile-reads", "reads")
    exact_percentile(spark.read.parquet(path), ["k"], "v", 0.95, "q").collect()
    spark.sparkContext.setJobGroup("other", "other")
    scans = 0
    for job in tracker.getJobIdsForGroup("percentile-reads"):
        for stage in tracker.getJobInfo(job).stageIds:
            info = tracker.getStageInfo(stage)
            scans += bool(info and info.numCompletedTasks and "parquet" in info.name.lower())
    assert scans <= 3
