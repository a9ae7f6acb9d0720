"""Mergeable states: day states, the month store, distinct states, exact counts in passes."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from daybook.operators.daily import TripColumns, daily_summary
from daybook.operators.distinct import distinct_estimates, distinct_states, exact_distinct, merged_distinct, passes_for, relative_error
from daybook.operators.states import MonthStates, day_states, merged_states, rank_error, sketched_quantiles, sketched_summary, summary_of
from daybook.sources import files as files_module
from daybook.sources.manifest import Manifest

DDL = (
    "tpep_pickup_datetime timestamp, trip_distance double, mta_tax double, "
    "fare_amount double, tip_amount double, passenger_count double"
)
NAN = float("nan")


def trips(month, n=90, seed=0):
    rng = random.Random(seed * 100 + month)
    pick = lambda: rng.choice([None, NAN, rng.uniform(0, 99), rng.uniform(0, 99), rng.uniform(0, 99)])
    real = lambda: rng.choice([None, rng.uniform(0, 99), rng.uniform(0, 99)])
    return [
        (None if i % 31 == 30 else dt.datetime(2021, month, 1 + i % 28, i % 24), real(), real(), real(), real(), pick())
        for i in range(n)
    ]


def rows(df):
    return sorted(map(repr, df.collect()))


def test_two_levels_equal_the_plain_summary(spark):
    df = spark.createDataFrame([r for m in (1, 2, 3) for r in trips(m)], DDL).repartition(7)
    want = rows(daily_summary(df, mean_digits=6))
    for salts in (1, 4):
        assert rows(sketched_summary(df, salts=salts, mean_digits=6)) == want
    assert rows(sketched_summary(df, year=2021, months=(2, 3), mean_digits=6)) == rows(daily_summary(df, year=2021, months=(2, 3), mean_digits=6))
    empty = df.where("false")
    assert sketched_summary(empty).collect() == []


def test_states_add_up_in_any_grouping(spark):
    df = spark.createDataFrame([r for m in (1, 2) for r in trips(m)] * 2, DDL)
    whole = day_states(df)
    parts = [day_states(df.where(F.pmod(F.xxhash64("trip_distance", "fare_amount"), F.lit(3)) == i)) for i in range(3)]
    again = merged_states(parts[0].union(parts[1]).union(parts[2]))
    assert rows(summary_of(again, mean_digits=6)) == rows(summary_of(whole, mean_digits=6))


def test_a_day_without_a_fare(spark):
    df = spark.createDataFrame([(dt.datetime(2021, 1, 1), 1.0, 1.0, None, 1.0, 1.0), (dt.datetime(2021, 1, 2), 1.0, 1.0, NAN, 1.0, NAN)], DDL)
    got = {r.dt_day: r for r in sketched_summary(df).collect()}
    assert got[1].q95_fare_amount is None and got[2].q95_fare_amount is None and got[2].mean_passenger_count is None


def test_ranks_stay_within_the_documented_error(spark):
    n = 200_000
    df = spark.range(n).select(F.pmod(F.xxhash64("id"), F.lit(n)).cast("double").alias("v"), (F.col("id") % 2).alias("g")).repartition(40)
    for k in (50, 200):
        for r in sketched_quantiles(df, ["g"], "v", [0.01, 0.5, 0.95], k=k, salts=8).collect():
            values = sorted(x.v for x in df.where(F.col("g") == r.g).select("v").collect())
            import bisect

            for q, v in zip([0.01, 0.5, 0.95], r.quantiles):
                low, high = bisect.bisect_left(values, v) / len(values), bisect.bisect_right(values, v) / len(values)
                assert low <= q + rank_error(k) and high >= q - rank_error(k)


def test_a_reducer_merges_few_buffers(spark):
    """A day's buffers of many scan tasks go to ``salts`` reducers: no group of the first level has more than tasks / salts."""
    tasks, salts = 120, 8
    df = spark.range(1200, numPartitions=tasks).select(F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt"), F.spark_partition_id().alias("task"))
    per_group = df.distinct().groupBy("salt").count().collect()
    assert max(r["count"] for r in per_group) == tasks // salts
    plan = day_states(spark.createDataFrame(trips(1), DDL), salts=salts)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("kll_sketch_agg_double") >= 2 and plan.count("kll_merge_agg_double") >= 2


@pytest.fixture
def month_files(spark, tmp_path):
    def write(month, n=90, seed=0):
        path = str(tmp_path / "in" / f"m={month:02d}")
        spark.createDataFrame(trips(month, n, seed), DDL).coalesce(1).write.mode("overwrite").parquet(path)
        return [path]

    return write


def test_the_store_reads_only_new_and_changed_months(spark, tmp_path, month_files, monkeypatch):
    inputs = {f"2021-{m:02d}": month_files(m) for m in range(1, 6)}
    store = MonthStates(spark, str(tmp_path / "store"))
    first = store.refresh({m: p for m, p in inputs.items() if m != "2021-05"})
    assert len(first.read) == 4 and first.kept == []
    second = store.refresh(inputs)
    assert (second.read, len(second.kept)) == (["2021-05"], 4)
    whole = spark.read.parquet(*[p for ps in inputs.values() for p in ps])
    assert rows(store.summary(mean_digits=6)) == rows(daily_summary(whole, mean_digits=6))
    assert rows(store.summary(year=2021, months=(2, 3), mean_digits=6)) == rows(daily_summary(whole, year=2021, months=(2, 3), mean_digits=6))

    # Nothing new: nothing is read, no version is written.
    version = store.manifest.version()
    assert store.refresh(inputs).read == [] and store.manifest.version() == version
    inputs["2021-02"] = month_files(2, 40, seed=5)  # the same name, other content
    third = store.refresh(inputs)
    assert third.read == ["2021-02"]
    whole = spark.read.parquet(*[p for ps in inputs.values() for p in ps])
    assert rows(store.summary(mean_digits=6)) == rows(daily_summary(whole, mean_digits=6))

    del inputs["2021-01"]
    assert store.refresh(inputs).dropped == ["2021-01"]
    # Rows without a time stand in every file; the dropped month's go with it.
    assert store.summary().where("dt_month = 1").collect() == []
    other = MonthStates(spark, str(tmp_path / "store"), TripColumns(fare="tip_amount"))
    assert len(other.refresh(inputs).read) == 4  # states of other columns are other states


def test_a_run_that_dies_leaves_the_last_version(spark, tmp_path, month_files, monkeypatch):
    inputs = {"2021-01": month_files(1)}
    store = MonthStates(spark, str(tmp_path / "store"))
    store.refresh(inputs)
    before = rows(store.summary())
    monkeypatch.setattr(Manifest, "publish", lambda self, rows: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        store.refresh({**inputs, "2021-02": month_files(2)})
    monkeypatch.undo()
    assert rows(store.summary()) == before
    assert store.refresh({**inputs, "2021-02": month_files(2)}).read == ["2021-02"]


def test_unreadable_paths_are_named_and_tried_again(spark, tmp_path, month_files):
    missing = str(tmp_path / "later")
    inputs = {"2021-01": [*month_files(1), missing]}
    store = MonthStates(spark, str(tmp_path / "store"))
    assert store.refresh(inputs).skipped == [(missing, "not_found")]
    gone = store.refresh({**inputs, "2021-03": [str(tmp_path / "none")]})
    assert gone.skipped[-1] == (str(tmp_path / "none"), "not_found") and store.summary().where("dt_month = 1").count() == 28
    with pytest.raises(FileNotFoundError):
        MonthStates(spark, str(tmp_path / "other")).refresh({"2021-03": [str(tmp_path / "none")]})
    spark.createDataFrame(trips(2), DDL).write.parquet(missing)
    assert store.refresh(inputs).read == ["2021-01"]
    assert store.summary().where("dt_month = 2").count() > 0


def test_manifest_versions(spark, tmp_path):
    book = Manifest(spark, str(tmp_path / "m"), "a bigint, b string")
    assert book.version() == 0 and book.rows().collect() == []
    assert book.publish(spark.createDataFrame([(1, "x")], "a bigint, b string")) == 1
    assert book.publish(spark.createDataFrame([], "a bigint, b string")) == 2
    assert book.rows().collect() == [] and [r.b for r in book.rows(1).collect()] == ["x"]


@pytest.fixture(scope="module")
def ids(spark):
    data = [(i % 3, None if i % 11 == 0 else f"u{i % 977}", i) for i in range(6000)]
    return spark.createDataFrame(data, "g int, u string, i bigint").repartition(6)


def test_distinct_states_merge(spark, ids):
    exact = {r.g: (r.u, r.i) for r in ids.groupBy("g").agg(F.count_distinct("u").alias("u"), F.count_distinct("i").alias("i")).collect()}
    parts = [distinct_states(ids.where(F.col("i") % 4 == j), {"u": "u", "i": "i"}, ["g"], salts=3) for j in range(4)]
    merged = merged_distinct(parts[0].union(parts[1]).union(parts[2]).union(parts[3]), ["u", "i"], ["g"])
    for r in distinct_estimates(merged, ["u", "i"]).collect():
        for got, want in zip((r.u, r.i), exact[r.g]):
            assert abs(got - want) <= 5 * relative_error() * want
    none = distinct_estimates(distinct_states(ids.where("false"), {"u": "u"}), ["u"]).collect()
    assert [r.u for r in none] == [0]
    nulls = spark.createDataFrame([(None,), (None,)], "u string")
    assert distinct_estimates(distinct_states(nulls, {"u": "u"}), ["u"]).first().u == 0


def test_exact_counts_in_any_number_of_passes(spark, ids):
    want = ids.agg(F.count_distinct("u").alias("users"), F.count_distinct("i").alias("n")).first()
    for passes in (None, 1, 4):
        got = exact_distinct(ids, {"users": "u", "n": "i"}, passes).first()
        assert got == want
    assert exact_distinct(ids, {"n": "i"}, most_values=200).first().n == want.n  # the sketches ask for passes
    assert exact_distinct(ids.where("false"), {"n": "i"}).first().n == 0
    assert passes_for(10**12, 10_000) == 25 and passes_for(5, 8) == 1
    with pytest.raises(ValueError):
        exact_distinct(ids, {})
    plan = ids.select("u").where("u is not null").distinct()._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_daily_states_survive_many_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files_module, "FEW_FILES", 0)
    path = str(tmp_path / "many")
    spark.createDataFrame(trips(4, 400), DDL).repartition(50).write.parquet(path)
    store = MonthStates(spark, str(tmp_path / "store"))
    store.refresh({"2021-04": [path]})
    assert rows(store.summary(mean_digits=6)) == rows(daily_summary(spark.read.parquet(path), mean_digits=6))
