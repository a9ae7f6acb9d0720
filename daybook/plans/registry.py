"""Registered queries over the supplied test tables, each with its DuckDB SQL.

The test tables stand in for the reference's inputs:

* trips    -> ``lineitem``: ``l_shipdate`` is the pickup time, year 1995 is
  the kept year, ``l_extendedprice`` is distance and fare, ``l_tax`` the MTA
  tax, ``l_discount`` the tip, ``l_quantity`` the passenger count;
* comments -> ``events``: ``event_id`` is the comment id, ``user_id`` the
  author, ``event_type`` the subreddit; ``created_utc`` is derived from
  ``ts`` without a time zone;
* the generated sequence -> ``orders.o_orderkey``.

Every query reads whole tables. Column names equal the SQL aliases.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.time import epoch_seconds, with_date_parts, year_equals, year_range
from daybook.operators.activity import (
    distinct_count,
    distinct_stats,
    distinct_values,
    hourly_counts,
    peak_hours,
    top_groups,
)
from daybook.operators.basic import even_double, row_count, sql_count
from daybook.operators.daily import (
    TripColumns,
    daily_overview,
    daily_summary,
    month_counts,
    newest_days,
)
from daybook.operators.distinct import distinct_estimates, distinct_states, exact_distinct, merged_distinct, relative_error
from daybook.operators.percentile import exact_percentile
from daybook.operators.states import MonthStates, rank_error, sketched_quantiles, sketched_summary
from daybook.session import ensure_checkpoint_dir
from daybook.sinks.csv import write_csv, write_small_csv
from daybook.sinks.ordered import positions, write_sorted_csv
from daybook.sinks.report import daily_report, overview_report, sample_rows
from daybook.sinks.tree import write_tree
from daybook.sources.copies import copy_new, read_copy
from daybook.sources.files import read_months, read_parquet, read_partitioned, stage
from daybook.sources.index import index_files, read_period
from daybook.sources.tree import list_tree, tree_sizes

KEPT_YEAR = 1995
FIRST_MONTHS = (1, 6)
MEAN_DIGITS = 6  # float sums depend on order; compare means at 6 decimals

LINEITEM_TRIPS = TripColumns(
    ts="l_shipdate",
    distance="l_extendedprice",
    tax="l_tax",
    fare="l_extendedprice",
    tip="l_discount",
    passengers="l_quantity",
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The test table ``name`` of ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with an epoch-seconds ``created_utc`` column, as comments carry."""
    ev = table(spark, sf_dir, "events")
    return ev.withColumn("created_utc", epoch_seconds(ev, "ts"))


def _daily(spark: SparkSession, sf_dir: str, exact: bool = False, ordered: bool = True) -> DataFrame:
    return daily_summary(
        table(spark, sf_dir, "lineitem"),
        LINEITEM_TRIPS,
        year=KEPT_YEAR,
        mean_digits=MEAN_DIGITS,
        exact=exact,
        ordered=ordered,
    )


def q_daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily(spark, sf_dir)


def q_daily_summary_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily(spark, sf_dir, exact=True)


def q_daily_first_half(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The month-subset load (months 1-6) feeding the daily summary.
    return daily_summary(
        table(spark, sf_dir, "lineitem"),
        LINEITEM_TRIPS,
        year=KEPT_YEAR,
        months=FIRST_MONTHS,
        mean_digits=MEAN_DIGITS,
    )


def q_daily_all_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    # No year kept: one row per day over the whole table.
    return daily_summary(table(spark, sf_dir, "lineitem"), LINEITEM_TRIPS, mean_digits=MEAN_DIGITS)


def q_daily_all_years_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_summary(table(spark, sf_dir, "lineitem"), LINEITEM_TRIPS, mean_digits=MEAN_DIGITS, exact=True)


def q_group_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Few large groups; bands joined shuffled and salted, values ranked in ranges (no broadcast, no window of a group).
    li = table(spark, sf_dir, "lineitem")
    return exact_percentile(
        li, ["l_returnflag"], "l_extendedprice", 0.95, "q95", accuracy=1000, broadcast_rows=0, window_values=0
    )


def q_tolerant_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The many-file load: the table plus a month that is not there.
    root = sf_dir.rstrip("/")
    loaded = read_months(spark, [f"{root}/lineitem.parquet", f"{root}/lineitem-missing.parquet"])
    return row_count(loaded.df, "total_rows").withColumn("skipped", F.lit(len(loaded.skipped)))


def q_glob_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_count(read_parquet(spark, f"{sf_dir.rstrip('/')}/linei*.parquet"), "total_rows")


def q_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_count(table(spark, sf_dir, "lineitem"), "total_rows")


def q_year_filter_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return row_count(li.where(year_range(li, "l_shipdate", KEPT_YEAR)), "filtered_rows")


def q_year_function_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The reference's own filter form, year(ts) = y. On its own it reaches the
    # scan only as IsNotNull; the implied half-open range (same rows) is added
    # so the Parquet reader can still skip row groups outside the year.
    li = table(spark, sf_dir, "lineitem")
    kept = year_equals("l_shipdate", KEPT_YEAR) & year_range(li, "l_shipdate", KEPT_YEAR)
    return row_count(li.where(kept), "filtered_rows")


def q_date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return with_date_parts(li, "l_shipdate")


def q_raw_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The reference's first look at the raw rows (show 5, untruncated), made
    # repeatable: every column is a sort key, so only identical rows tie. The
    # top-k scan reads the first key only.
    li = table(spark, sf_dir, "lineitem")
    return sample_rows(li, 5, li.columns)


def q_month_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return month_counts(table(spark, sf_dir, "lineitem"), "l_shipdate", KEPT_YEAR, FIRST_MONTHS)


def q_daily_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The top-k orders the days itself; the full sort would be wasted.
    return newest_days(_daily(spark, sf_dir, ordered=False), 20)


def q_daily_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_overview(_daily(spark, sf_dir, ordered=False))


def q_daily_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The per-day text report of the five newest days (a top-k: the feature).
    return daily_report(_daily(spark, sf_dir, ordered=False), 5)


def q_overview_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overview_report(daily_overview(_daily(spark, sf_dir, ordered=False)))


def q_dataset_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_stats(comments(spark, sf_dir), {"unique_comments": "event_id", "unique_users": "user_id"})


def q_distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_values(comments(spark, sf_dir), "event_type")


def q_distinct_count_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    # One type is blanked to NULL on purpose: the two readings then differ by one.
    ev = comments(spark, sf_dir)
    kind = F.when(F.col("event_type") != F.lit("error"), F.col("event_type"))
    return distinct_count(ev, kind, "n_excl", "n_incl")


def q_top_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_groups(comments(spark, sf_dir), "user_id", 10)


def q_top_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_groups(comments(spark, sf_dir), "event_type", 10)


def q_hourly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly_counts(comments(spark, sf_dir), "created_utc")


def q_peak_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return peak_hours(comments(spark, sf_dir), "created_utc", 1)


def q_sql_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql_count(table(spark, sf_dir, "orders"), "test_table", "total")


def q_even_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The installation check's filter-and-double step itself (keep even ids,
    # double them), over the whole table.
    return even_double(table(spark, sf_dir, "orders"), "o_orderkey", "id2")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def monthly_trips(spark: SparkSession, sf_dir: str) -> str:
    """All trips as a tree ``yyyy=/mm=`` with one file per month, as trip data comes; returns its root."""
    # Two-digit directory names, as text.
    parts = {"yyyy": F.date_format("l_shipdate", "yyyy"), "mm": F.date_format("l_shipdate", "MM")}
    return write_tree(table(spark, sf_dir, "lineitem"), scratch(spark, "trips"), parts)


def daily_comments(spark: SparkSession, sf_dir: str) -> str:
    """All comments as a tree ``mm=/dd=``; returns its root."""
    parts = {"mm": F.date_format("ts", "MM"), "dd": F.date_format("ts", "dd")}
    return write_tree(comments(spark, sf_dir), scratch(spark, "comments"), parts)


def comment_days(spark: SparkSession, sf_dir: str) -> T.StructType:
    """The schema of ``daily_comments``."""
    return comments(spark, sf_dir).schema.add("mm", T.IntegerType()).add("dd", T.IntegerType())


def q_daily_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Mergeable states per (day, salt), then per day; a day of at most k fares is exact.
    return sketched_summary(table(spark, sf_dir, "lineitem"), LINEITEM_TRIPS, year=KEPT_YEAR, mean_digits=MEAN_DIGITS)


def q_sketched_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Big groups: does each quantile's true rank lie within the documented error?
    li = table(spark, sf_dir, "lineitem")
    k, wanted = 200, [0.05, 0.5, 0.95]
    told = sketched_quantiles(li, ["l_returnflag"], "l_extendedprice", wanted, k=k)
    v = F.col("l_extendedprice").cast("double")
    counted = li.join(F.broadcast(told), "l_returnflag").groupBy("l_returnflag", "n")
    checks = []
    for i, q in enumerate(wanted):
        at = F.col("quantiles")[i]
        low, high = F.count(F.when(v < at, 1)), F.count(F.when(v <= at, 1))
        checks.append((low / F.col("n") <= q + rank_error(k)) & (high / F.col("n") >= q - rank_error(k)))
    return counted.agg((checks[0] & checks[1] & checks[2]).alias("within"))


def q_stored_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Eleven months stored, then twelve: the second run reads one, and its summary is the whole year's.
    root = monthly_trips(spark, sf_dir)
    months = {f"{KEPT_YEAR}-{m:02d}": [f"{root}/yyyy={KEPT_YEAR}/mm={m:02d}"] for m in range(1, 13)}
    store = MonthStates(spark, scratch(spark, "months"), LINEITEM_TRIPS)
    store.refresh({m: p for m, p in months.items() if not m.endswith("-12")}, required=False)
    second = store.refresh(months, required=False)
    return store.summary(mean_digits=MEAN_DIGITS).withColumn("months_read", F.lit(len(second.read)))


def q_indexed_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Monthly files chosen by the bounds in their footers before the scan is planned.
    index = index_files(spark, [monthly_trips(spark, sf_dir)], "l_shipdate")
    schema = table(spark, sf_dir, "lineitem").schema
    period = read_period(spark, index, "l_shipdate", KEPT_YEAR, FIRST_MONTHS, schema)
    months = month_counts(period.df, "l_shipdate", KEPT_YEAR, FIRST_MONTHS)
    return months.withColumns({"files_read": F.lit(period.files_read), "files_total": F.lit(period.files_total)})


def q_tree_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = tree_sizes(list_tree(spark, [monthly_trips(spark, sf_dir)]))
    return sizes.select(F.regexp_extract("directory", "(yyyy=[0-9]+/mm=[0-9]+)$", 1).alias("part"), "n_files")


def q_distinct_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The dataset statistics, exactly, in three hash ranges and without Expand.
    return exact_distinct(comments(spark, sf_dir), {"unique_comments": "event_id", "unique_users": "user_id"}, passes=3)


def q_distinct_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Sketches per type and day merged per type: within five standard errors of the exact count?
    ev = comments(spark, sf_dir).withColumn("dd", F.dayofmonth("ts"))
    daily = distinct_states(ev, {"users": "user_id"}, keys=["event_type", "dd"])
    told = distinct_estimates(merged_distinct(daily, ["users"], ["event_type"]), ["users"])
    exact = ev.groupBy("event_type").agg(F.count_distinct("user_id").alias("n_users"))
    apart = F.abs(F.col("users") - F.col("n_users"))
    return exact.join(told, "event_type").select(
        "event_type", "n_users", (apart <= 5 * relative_error() * F.col("n_users")).alias("within")
    )


def q_copied_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A copy of the comments' tree, and a second run that finds nothing new.
    src, dst = daily_comments(spark, sf_dir), scratch(spark, "copy")
    copy_new(spark, src, dst, ("mm", "dd"))
    again = copy_new(spark, src, dst, ("mm", "dd"))
    copied = read_copy(spark, dst, schema=comment_days(spark, sf_dir))
    counts = copied.groupBy("mm", "dd").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))
    return counts.withColumn("copied_again", F.lit(again.files))


def q_staged_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The days of a month staged twice: a rerun rewrites its partitions and doubles nothing.
    src, dst, schema = daily_comments(spark, sf_dir), scratch(spark, "staged"), comment_days(spark, sf_dir)
    spark.createDataFrame([], schema).write.partitionBy("mm", "dd").parquet(dst)
    for m in [r.mm for r in spark.read.schema(schema).parquet(src).select("mm").distinct().collect()]:  # at most twelve
        for _ in range(2):
            stage(spark, src, dst, {"mm": m}, ("mm", "dd"))
    return spark.read.schema(schema).parquet(dst).groupBy("mm", "dd").agg(F.count(F.lit(1)).alias("n"))


def q_partitioned_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The partition columns are filters on directories; they stay columns.
    one = read_partitioned(spark, daily_comments(spark, sf_dir), {"mm": 1, "dd": 5}, schema=comment_days(spark, sf_dir))
    return one.select("event_id", "user_id", "event_type", "created_utc", "mm", "dd")


def q_one_file_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = hourly_counts(comments(spark, sf_dir), "created_utc")
    path = write_small_csv(hours, scratch(spark, "hours"), ["hour"], max_rows=25)
    return spark.read.option("header", True).schema("hour int, n bigint").csv(path)


def q_distributed_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = comments(spark, sf_dir).select("event_id", "user_id", "event_type", "created_utc")
    path = write_csv(users, scratch(spark, "events"))
    return spark.read.option("header", True).schema(users.schema).csv(path)


def q_sorted_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    # All comments newest first over several files, with the place that each row has in them.
    rows = comments(spark, sf_dir).select("event_id", "user_id", "created_utc")
    path = scratch(spark, "sorted")
    write_sorted_csv(rows, path, [F.col("created_utc").desc(), F.col("event_id").desc()], rows_per_file=1500)
    return positions(spark.read.option("header", True).schema(rows.schema).csv(path))


QUERIES: dict[str, Query] = {
    "daily_summary": q_daily_summary,
    "daily_summary_exact": q_daily_summary_exact,
    "daily_first_half": q_daily_first_half,
    "daily_all_years": q_daily_all_years,
    "daily_all_years_exact": q_daily_all_years_exact,
    "group_percentiles": q_group_percentiles,
    "tolerant_load": q_tolerant_load,
    "glob_scan": q_glob_scan,
    "row_count": q_row_count,
    "year_filter_count": q_year_filter_count,
    "year_function_count": q_year_function_count,
    "date_parts": q_date_parts,
    "raw_sample": q_raw_sample,
    "month_subset": q_month_subset,
    "daily_top20": q_daily_top20,
    "daily_overview": q_daily_overview,
    "daily_report": q_daily_report,
    "overview_report": q_overview_report,
    "dataset_stats": q_dataset_stats,
    "distinct_values": q_distinct_values,
    "distinct_count_nulls": q_distinct_count_nulls,
    "top_groups": q_top_groups,
    "top_categories": q_top_categories,
    "hourly_counts": q_hourly_counts,
    "peak_hour": q_peak_hour,
    "sql_count": q_sql_count,
    "even_double": q_even_double,
    "daily_sketched": q_daily_sketched,
    "sketched_ranks": q_sketched_ranks,
    "stored_months": q_stored_months,
    "indexed_period": q_indexed_period,
    "tree_listing": q_tree_listing,
    "distinct_passes": q_distinct_passes,
    "distinct_merged": q_distinct_merged,
    "copied_tree": q_copied_tree,
    "staged_partitions": q_staged_partitions,
    "partitioned_read": q_partitioned_read,
    "one_file_csv": q_one_file_csv,
    "distributed_csv": q_distributed_csv,
    "sorted_csv": q_sorted_csv,
}


_DAILY_SELECT = """SELECT CAST(year(l_shipdate) AS INT) AS dt_year,
       CAST(month(l_shipdate) AS INT) AS dt_month,
       CAST(day(l_shipdate) AS INT) AS dt_day,
       count(*) AS num_trips,
       round(avg(l_extendedprice), 6) AS mean_trip_distance,
       max(l_tax) AS max_mta_tax,
       quantile_disc(l_extendedprice, 0.95) AS q95_fare_amount,
       min(l_discount) AS min_tip_amount,
       CAST(ceil(avg(l_quantity)) AS BIGINT) AS mean_passenger_count
FROM lineitem"""

_DAILY_SQL = f"""{_DAILY_SELECT}
WHERE year(l_shipdate) = 1995
GROUP BY 1, 2, 3"""

ORACLE_SQL: dict[str, str] = {
    "daily_summary": _DAILY_SQL,
    "daily_summary_exact": _DAILY_SQL,
    "daily_first_half": f"""{_DAILY_SELECT}
WHERE year(l_shipdate) = 1995 AND month(l_shipdate) BETWEEN 1 AND 6
GROUP BY 1, 2, 3""",
    "daily_all_years": f"""{_DAILY_SELECT}
GROUP BY 1, 2, 3""",
    "daily_all_years_exact": f"""{_DAILY_SELECT}
GROUP BY 1, 2, 3""",
    "group_percentiles": (
        "SELECT l_returnflag, percentile_disc(0.95) WITHIN GROUP (ORDER BY l_extendedprice) AS q95 "
        "FROM lineitem WHERE l_extendedprice IS NOT NULL GROUP BY 1"
    ),
    "tolerant_load": "SELECT count(*) AS total_rows, 1 AS skipped FROM lineitem",
    "glob_scan": "SELECT count(*) AS total_rows FROM lineitem",
    "row_count": "SELECT count(*) AS total_rows FROM lineitem",
    "year_function_count": "SELECT count(*) AS filtered_rows FROM lineitem WHERE year(l_shipdate) = 1995",
    "year_filter_count": (
        "SELECT count(*) AS filtered_rows FROM lineitem "
        "WHERE l_shipdate >= TIMESTAMP '1995-01-01' AND l_shipdate < TIMESTAMP '1996-01-01'"
    ),
    "date_parts": (
        "SELECT l_orderkey, l_linenumber, l_shipdate, CAST(year(l_shipdate) AS INT) AS dt_year, "
        "CAST(month(l_shipdate) AS INT) AS dt_month, CAST(day(l_shipdate) AS INT) AS dt_day FROM lineitem"
    ),
    "raw_sample": (
        "SELECT * FROM lineitem ORDER BY "
        + ", ".join(
            f"{c} ASC NULLS FIRST"
            for c in (
                "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice "
                "l_discount l_tax l_returnflag l_linestatus l_shipdate"
            ).split()
        )
        + " LIMIT 5"
    ),
    "month_subset": (
        "SELECT CAST(month(l_shipdate) AS INT) AS dt_month, count(*) AS num_trips FROM lineitem "
        "WHERE year(l_shipdate) = 1995 AND month(l_shipdate) BETWEEN 1 AND 6 GROUP BY 1"
    ),
    "daily_top20": f"SELECT * FROM ({_DAILY_SQL}) d ORDER BY dt_year DESC, dt_month DESC, dt_day DESC LIMIT 20",
    "daily_overview": f"""SELECT CAST(coalesce(sum(num_trips), 0) AS BIGINT) AS total_trips,
       count(*) AS total_days,
       round_even(avg(num_trips), 0) AS avg_daily_trips,
       min(make_date(dt_year, dt_month, dt_day)) AS first_day,
       max(make_date(dt_year, dt_month, dt_day)) AS last_day,
       printf('%02d/%02d/%d to %02d/%02d/%d', min(dt_month), min(dt_day), max(dt_year),
              max(dt_month), max(dt_day), max(dt_year)) AS component_range
FROM ({_DAILY_SQL}) d""",
    "daily_report": f"""SELECT dt_year, dt_month, dt_day, day_label, trips, avg_distance, max_tax, q95_fare,
       min_tip, avg_passengers,
       concat_ws(chr(10), day_label, '  ' || trips, '  ' || avg_distance, '  ' || max_tax,
                 '  ' || q95_fare, '  ' || min_tip, '  ' || avg_passengers) AS text
FROM (
  SELECT dt_year, dt_month, dt_day,
         printf('Year: %d, Month: %02d, Day: %02d', dt_year, dt_month, dt_day) AS day_label,
         'Trips: ' || format('{{:,}}', num_trips) AS trips,
         'Avg Distance: ' || coalesce(printf('%.2f', mean_trip_distance), 'nan') || ' miles' AS avg_distance,
         'Max MTA Tax: $' || coalesce(printf('%.2f', max_mta_tax), 'nan') AS max_tax,
         '95th Percentile Fare: $' || coalesce(printf('%.2f', q95_fare_amount), 'nan') AS q95_fare,
         'Min Tip: $' || coalesce(printf('%.2f', min_tip_amount), 'nan') AS min_tip,
         'Avg Passengers: ' || coalesce(printf('%.0f', CAST(mean_passenger_count AS DOUBLE)), 'nan') AS avg_passengers
  FROM ({_DAILY_SQL}) d
  ORDER BY dt_year DESC, dt_month DESC, dt_day DESC
  LIMIT 5
) r""",
    "overview_report": f"""SELECT 'Rows in period: ' || format('{{:,}}', total_trips) AS rows_line,
       printf('Days with data: %d', total_days) AS days_line,
       printf('Date range: %s to %s', CAST(first_day AS VARCHAR), CAST(last_day AS VARCHAR)) AS range_line,
       printf('Date range (month/day min-max): %s', component_range) AS component_line,
       'Total trips: ' || format('{{:,}}', total_trips) AS trips_line,
       'Average daily trips: ' || coalesce(printf('%.0f', avg_daily_trips), 'nan') AS mean_line
FROM (
  SELECT CAST(coalesce(sum(num_trips), 0) AS BIGINT) AS total_trips,
         count(*) AS total_days,
         round_even(avg(num_trips), 0) AS avg_daily_trips,
         min(make_date(dt_year, dt_month, dt_day)) AS first_day,
         max(make_date(dt_year, dt_month, dt_day)) AS last_day,
         printf('%02d/%02d/%d to %02d/%02d/%d', min(dt_month), min(dt_day), max(dt_year),
                max(dt_month), max(dt_day), max(dt_year)) AS component_range
  FROM ({_DAILY_SQL}) d
) o""",
    "dataset_stats": (
        "SELECT count(DISTINCT event_id) AS unique_comments, count(DISTINCT user_id) AS unique_users FROM events"
    ),
    "distinct_values": "SELECT DISTINCT event_type FROM events",
    "distinct_count_nulls": (
        "SELECT count(DISTINCT nullif(event_type, 'error')) AS n_excl, "
        "(SELECT count(*) FROM (SELECT DISTINCT nullif(event_type, 'error') FROM events) t) AS n_incl "
        "FROM events"
    ),
    "top_groups": "SELECT user_id, count(*) AS n FROM events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
    "top_categories": "SELECT event_type, count(*) AS n FROM events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
    "hourly_counts": 'SELECT CAST(hour(ts) AS INT) AS "hour", count(*) AS n FROM events GROUP BY 1',
    "peak_hour": 'SELECT CAST(hour(ts) AS INT) AS "hour", count(*) AS n FROM events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1',
    "daily_sketched": _DAILY_SQL,
    "sketched_ranks": "SELECT l_returnflag, count(l_extendedprice) AS n, TRUE AS within FROM lineitem GROUP BY 1",
    "stored_months": f"SELECT *, 1 AS months_read FROM ({_DAILY_SQL}) d",
    "indexed_period": """SELECT CAST(month(l_shipdate) AS INT) AS dt_month, count(*) AS num_trips, 6 AS files_read,
       CAST((SELECT count(DISTINCT strftime(l_shipdate, '%Y%m')) FROM lineitem) AS INT) AS files_total
FROM lineitem WHERE year(l_shipdate) = 1995 AND month(l_shipdate) BETWEEN 1 AND 6 GROUP BY 1""",
    "tree_listing": "SELECT DISTINCT strftime(l_shipdate, 'yyyy=%Y/mm=%m') AS part, CAST(1 AS BIGINT) AS n_files FROM lineitem",
    "distinct_passes": (
        "SELECT count(DISTINCT event_id) AS unique_comments, count(DISTINCT user_id) AS unique_users FROM events"
    ),
    "distinct_merged": "SELECT event_type, count(DISTINCT user_id) AS n_users, TRUE AS within FROM events GROUP BY 1",
    "copied_tree": """SELECT CAST(month(ts) AS INT) AS mm, CAST(day(ts) AS INT) AS dd, count(*) AS n,
       CAST(sum(event_id) AS BIGINT) AS ids, 0 AS copied_again FROM events GROUP BY 1, 2""",
    "staged_partitions": (
        "SELECT CAST(month(ts) AS INT) AS mm, CAST(day(ts) AS INT) AS dd, count(*) AS n FROM events GROUP BY 1, 2"
    ),
    "partitioned_read": """SELECT event_id, user_id, event_type, CAST(floor(epoch(ts)) AS BIGINT) AS created_utc,
       CAST(month(ts) AS INT) AS mm, CAST(day(ts) AS INT) AS dd FROM events WHERE month(ts) = 1 AND day(ts) = 5""",
    "one_file_csv": 'SELECT CAST(hour(ts) AS INT) AS "hour", count(*) AS n FROM events GROUP BY 1',
    "distributed_csv": (
        "SELECT event_id, user_id, event_type, CAST(floor(epoch(ts)) AS BIGINT) AS created_utc FROM events"
    ),
    "sorted_csv": """SELECT event_id, user_id, created_utc,
       row_number() OVER (ORDER BY created_utc DESC, event_id DESC) AS position
FROM (SELECT event_id, user_id, CAST(floor(epoch(ts)) AS BIGINT) AS created_utc FROM events) e""",
    "sql_count": "SELECT count(*) AS total FROM orders",
    "even_double": "SELECT o_orderkey * 2 AS id2 FROM orders WHERE o_orderkey % 2 = 0",
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference's main job: the daily summary of the kept year."""
    return q_daily_summary(spark, sf_dir)
