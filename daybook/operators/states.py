"""Daily summaries from mergeable states, and a store of them by month.

A day's state holds what its row of the summary needs and can be added to that
of another set of rows: counts, sums, extremes and a KLL quantile sketch of
the fare. States are made in two levels. The first groups by day and by the
number of the scan task modulo ``salts``; a task has one such number, so it
still hands over one buffer per day, but a day's buffers from all tasks go to
``salts`` reducers instead of one. The second merges at most ``salts`` states
per day. With 5,000 scan tasks and 64 salts no reducer merges more than 79
buffers of a day.

``MonthStates`` keeps the states of each month's files. A run over many months
reads only the months whose files are new or have changed; the others' states
(at most some tens of small rows each) are merged from the store.

The sketch's rank error is ``rank_error(k)`` of a day's fares at 99 % confidence,
also after merging; a day of at most ``k`` fares gives the exact discrete
percentile. NaN fares are not counted by the sketch.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.numeric import nan_to_null
from daybook.functions.time import date_parts
from daybook.operators.daily import DAY_KEYS, SUMMARY_COLUMNS, TripColumns, newest_first, select_period
from daybook.sources.errors import OK
from daybook.sources.files import Loaded, NothingRead, read_months
from daybook.sources.footers import opens
from daybook.sources.listing import list_files
from daybook.sources.manifest import Manifest
from daybook.sources.tree import FILE, list_tree

SKETCH_SIZE = 2000
SALTS = 64

STATE = (
    "dt_year int, dt_month int, dt_day int, n bigint, distance_sum double, distance_n bigint, max_tax double, "
    "min_tip double, passengers_sum double, passengers_n bigint, fare_n bigint, fares binary"
)


def rank_error(k: int) -> float:
    """Error of a KLL sketch's ranks, as a share of the rows, at 99 % confidence (the published fit)."""
    return 2.296 / k**0.9723


def _salted(df: DataFrame, salts: int) -> DataFrame:
    return df.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))


def _merged(sketch: str) -> Column:
    return F.kll_merge_agg_double(sketch)


def day_states(
    df: DataFrame,
    cols: TripColumns = TripColumns(),
    keys: Sequence[str] = (),
    k: int = SKETCH_SIZE,
    salts: int = SALTS,
    nan_as_null: bool = True,
) -> DataFrame:
    """One state per day (and further ``keys``, columns of ``df``): the columns of ``STATE`` after the keys."""
    passengers = nan_to_null(df, cols.passengers) if nan_as_null else F.col(cols.passengers)
    fare = F.col(cols.fare).cast("double")
    src = df.select(
        *keys,
        *[part.alias(name) for name, part in date_parts(cols.ts).items()],
        F.col(cols.distance).cast("double").alias("_distance"),
        F.col(cols.tax).cast("double").alias("_tax"),
        F.col(cols.tip).cast("double").alias("_tip"),
        passengers.cast("double").alias("_passengers"),
        F.when(~F.isnan(fare), fare).alias("_fare"),
    )
    partial = _salted(src, salts).groupBy(*keys, *DAY_KEYS, "_salt").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("_distance").alias("distance_sum"),
        F.count("_distance").alias("distance_n"),
        F.max("_tax").alias("max_tax"),
        F.min("_tip").alias("min_tip"),
        F.sum("_passengers").alias("passengers_sum"),
        F.count("_passengers").alias("passengers_n"),
        F.count("_fare").alias("fare_n"),
        F.kll_sketch_agg_double("_fare", k).alias("fares"),
    )
    return merged_states(partial, keys)


def merged_states(states: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """States of the same day (and ``keys``) as one."""
    return states.groupBy(*keys, *DAY_KEYS).agg(
        F.sum("n").alias("n"),
        F.sum("distance_sum").alias("distance_sum"),
        F.sum("distance_n").alias("distance_n"),
        F.max("max_tax").alias("max_tax"),
        F.min("min_tip").alias("min_tip"),
        F.sum("passengers_sum").alias("passengers_sum"),
        F.sum("passengers_n").alias("passengers_n"),
        F.sum("fare_n").alias("fare_n"),
        _merged("fares").alias("fares"),
    )


def summary_of(states: DataFrame, quantile: float = 0.95, mean_digits: int | None = None, ordered: bool = True) -> DataFrame:
    """The daily summary (``SUMMARY_COLUMNS``) of merged states, one per day."""
    mean = F.when(F.col("distance_n") > 0, F.col("distance_sum") / F.col("distance_n"))
    if mean_digits is not None:
        mean = F.round(mean, mean_digits)
    passengers = F.when(F.col("passengers_n") > 0, F.col("passengers_sum") / F.col("passengers_n"))
    out = states.select(
        *DAY_KEYS,
        F.col("n").alias("num_trips"),
        mean.alias("mean_trip_distance"),
        F.col("max_tax").alias("max_mta_tax"),
        # An empty sketch has no quantile.
        F.when(F.col("fare_n") > 0, F.kll_sketch_get_quantile_double("fares", F.lit(quantile))).alias("q95_fare_amount"),
        F.col("min_tip").alias("min_tip_amount"),
        F.ceil(passengers).cast("bigint").alias("mean_passenger_count"),
    ).select(*SUMMARY_COLUMNS)
    return newest_first(out) if ordered else out


def sketched_summary(
    df: DataFrame,
    cols: TripColumns = TripColumns(),
    year: int | None = None,
    months: tuple[int, int] | None = None,
    quantile: float = 0.95,
    k: int = SKETCH_SIZE,
    salts: int = SALTS,
    mean_digits: int | None = None,
    ordered: bool = True,
) -> DataFrame:
    """The daily summary through two levels of states, for inputs of very many scan tasks."""
    states = day_states(select_period(df, cols.ts, year, months), cols, k=k, salts=salts)
    return summary_of(states, quantile, mean_digits, ordered)


def sketched_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, quantiles: Sequence[float], k: int = SKETCH_SIZE, salts: int = SALTS
) -> DataFrame:
    """Per group: ``keys, n`` (values that are neither NULL nor NaN) and ``quantiles``, an array of as many values."""
    v = F.col(value).cast("double")
    rows = _salted(df.select(*keys, F.when(~F.isnan(v), v).alias("_v")), salts)
    partial = rows.groupBy(*keys, "_salt").agg(F.count("_v").alias("n"), F.kll_sketch_agg_double("_v", k).alias("s"))
    merged = partial.groupBy(*keys).agg(F.sum("n").alias("n"), _merged("s").alias("s"))
    values = F.kll_sketch_get_quantile_double("s", F.array(*[F.lit(float(q)) for q in quantiles]))
    return merged.select(*keys, "n", F.when(F.col("n") > 0, values).alias("quantiles"))


@dataclass(frozen=True)
class Refreshed:
    """What a refresh read, kept and dropped (names of months)."""

    read: list[str]
    kept: list[str]
    dropped: list[str]
    skipped: list[tuple[str, str]]


class MonthStates:
    """Day states of months, stored under ``root`` and kept up to date with the months' files."""

    FIELDS = "month string, mark string, path string, rows bigint"

    def __init__(self, spark: SparkSession, root: str, cols: TripColumns = TripColumns(), k: int = SKETCH_SIZE) -> None:
        self.spark, self.root, self.cols, self.k = spark, root.rstrip("/"), cols, k
        self.manifest = Manifest(spark, f"{self.root}/manifest", self.FIELDS)

    def marks(self, inputs: Mapping[str, Sequence[str]]) -> dict[str, str]:
        """A digest per month of its files' names, sizes and times of change and of what is made of them."""
        every = sorted({p for paths in inputs.values() for p in paths})
        if all(map(opens, every)):
            files = list_tree(self.spark, every).where((F.col("kind") == FILE) & (F.col("status") == OK))
            files = files.select("root", "path", "length", "modified")
        else:
            shown = lambda p: list_files(self.spark, p, recursive=True).select(
                F.lit(p).alias("root"), "path", "length", F.unix_micros("modificationTime").alias("modified")
            )
            files = reduce(DataFrame.union, map(shown, every))
        told = F.array_sort(F.collect_list(F.concat_ws("|", "path", "length", "modified")))
        of = {r.root: r.d for r in files.groupBy("root").agg(F.sha2(F.array_join(told, "\n"), 256).alias("d")).collect()}
        made = repr((sorted(asdict(self.cols).items()), self.k, STATE))
        join = lambda paths: "\n".join([made, *(f"{p} {of.get(p, '-')}" for p in paths)])
        return {m: hashlib.sha256(join(paths).encode()).hexdigest() for m, paths in inputs.items()}

    def _load(self, paths: Sequence[str], schema: T.StructType | None) -> Loaded | NothingRead:
        try:
            return read_months(self.spark, paths, schema=schema)
        except NothingRead as exc:
            return exc

    def refresh(
        self, inputs: Mapping[str, Sequence[str]], schema: T.StructType | None = None, required: bool = True
    ) -> Refreshed:
        """Bring the store to exactly the months of ``inputs`` (month -> its paths); reads only what is new or changed.

        New states are written to a folder of their own and become visible
        with the next version of the manifest. Paths that can't be read are
        left out as in ``read_months`` and named in the result; their month is
        read again next time. Raises where no month holds anything, unless nothing is ``required``.
        """
        marks = self.marks(inputs)
        held = {r.month: r for r in self.manifest.rows().collect()}  # one row per month
        kept = [m for m in inputs if m in held and held[m].mark == marks[m]]
        read = [m for m in inputs if m not in kept]
        skipped: list[tuple[str, str]] = []
        rows = [tuple(held[m]) for m in kept]
        if read:
            with ThreadPoolExecutor(max_workers=8) as pool:  # listings are round trips to storage
                loads = list(pool.map(lambda m: self._load(inputs[m], schema), read))
            skipped = [x for loaded in loads for x in loaded.skipped]
            whole = [not loaded.skipped for loaded in loads]
            parts = [x.df.withColumn("_month", F.lit(m)) for m, x in zip(read, loads) if not isinstance(x, NothingRead)]
            if not parts and not kept and required:
                raise NothingRead(skipped)
            folder = f"{self.root}/states/{uuid.uuid4().hex}"
            counts = {}
            if parts:
                new = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
                day_states(new, self.cols, keys=["_month"], k=self.k).write.partitionBy("_month").parquet(folder)
                states = self.spark.read.schema(f"{STATE}, _month string").parquet(folder)
                counts = {r._month: r.n for r in states.groupBy("_month").agg(F.sum("n").alias("n")).collect()}
            rows += [
                (m, marks[m] if ok else "", folder if m in counts else None, counts.get(m, 0)) for m, ok in zip(read, whole)
            ]
        dropped = sorted(set(held) - set(inputs))
        if read or dropped:
            self.manifest.publish(self.spark.createDataFrame(rows, self.FIELDS))
        return Refreshed(read, kept, dropped, skipped)

    def states(self) -> DataFrame:
        """The merged states of all published months."""
        folders: dict[str, list[str]] = {}
        for r in self.manifest.rows().where("path is not null").collect():  # one row per month
            folders.setdefault(r.path, []).append(r.month)
        schema = f"{STATE}, _month string"
        parts = [
            self.spark.read.schema(schema).parquet(f).where(F.col("_month").isin(ms)).drop("_month") for f, ms in folders.items()
        ]
        if not parts:
            return self.spark.createDataFrame([], STATE)
        return merged_states(reduce(DataFrame.union, parts))

    def summary(
        self, year: int | None = None, months: tuple[int, int] | None = None, quantile: float = 0.95,
        mean_digits: int | None = None, ordered: bool = True,
    ) -> DataFrame:
        """The daily summary of the published months, of a year or a month span of it if given."""
        states = self.states()
        if year is not None:
            states = states.where(F.col("dt_year") == year)
        if months is not None:
            states = states.where(F.col("dt_month").between(*months))
        return summary_of(states, quantile, mean_digits, ordered)
