"""Readable reports, schema profiles and guarded driver conversion.

Formatting runs on the executors with built-in expressions; only the few
finished rows of a report reach the driver. Numbers print as Python's
format mini-language prints them (``daybook.functions.text``), so the per-day
lines equal the reference's; the overview has labels and a date-range line of
its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.text import fixed, grouped
from daybook.operators.daily import newest_days

# The per-day report's lines, in printed order. Trips print with
# thousands separators, amounts with two decimals, the passenger mean with none.
DAY_LABEL = "Year: %d, Month: %02d, Day: %02d"
TRIPS_LABEL = "Trips: %s"
DISTANCE_LABEL = "Avg Distance: %s miles"
TAX_LABEL = "Max MTA Tax: $%s"
FARE_LABEL = "95th Percentile Fare: $%s"
TIP_LABEL = "Min Tip: $%s"
PASSENGERS_LABEL = "Avg Passengers: %s"

# The run overview's lines, in printed order.
ROWS_LABEL = "Rows in period: %s"
DAYS_LABEL = "Days with data: %d"
RANGE_LABEL = "Date range: %s to %s"
COMPONENT_RANGE_LABEL = "Date range (month/day min-max): %s"
TOTAL_TRIPS_LABEL = "Total trips: %s"
MEAN_TRIPS_LABEL = "Average daily trips: %s"


def daily_report(daily: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` newest days as labelled text fields plus one ``text`` block each."""
    top = newest_days(daily, n)
    fields = {
        "day_label": F.format_string(DAY_LABEL, "dt_year", "dt_month", "dt_day"),
        "trips": F.format_string(TRIPS_LABEL, grouped("num_trips")),
        "avg_distance": F.format_string(DISTANCE_LABEL, fixed("mean_trip_distance", 2)),
        "max_tax": F.format_string(TAX_LABEL, fixed("max_mta_tax", 2)),
        "q95_fare": F.format_string(FARE_LABEL, fixed("q95_fare_amount", 2)),
        "min_tip": F.format_string(TIP_LABEL, fixed("min_tip_amount", 2)),
        "avg_passengers": F.format_string(PASSENGERS_LABEL, fixed("mean_passenger_count", 0)),
    }
    # ``text`` repeats the field expressions instead of referring to the
    # aliases: one projection over the top-k keeps the plan a single
    # TakeOrderedAndProject (a second projection on top would turn it into a
    # limit over a global, range-sampled sort).
    exprs = list(fields.values())
    text = F.concat_ws("\n", exprs[0], *[F.concat(F.lit("  "), e) for e in exprs[1:]])
    return top.select(
        "dt_year", "dt_month", "dt_day", *[c.alias(k) for k, c in fields.items()], text.alias("text")
    )


def overview_report(overview: DataFrame) -> DataFrame:
    """Summary lines over ``daily_overview``: days, date ranges, totals, mean per day.

    With no day in the period the two date-range lines are NULL (no range to
    print) and the mean prints ``nan``, as a mean over no days does in Python.
    """
    has_days = F.col("total_days") > 0
    cols = [
        F.format_string(ROWS_LABEL, grouped("total_trips")).alias("rows_line"),
        F.format_string(DAYS_LABEL, "total_days").alias("days_line"),
        F.when(
            has_days,
            F.format_string(RANGE_LABEL, F.col("first_day").cast("string"), F.col("last_day").cast("string")),
        ).alias("range_line"),
        F.when(has_days, F.format_string(COMPONENT_RANGE_LABEL, "component_range")).alias("component_line"),
        F.format_string(TOTAL_TRIPS_LABEL, grouped("total_trips")).alias("trips_line"),
        F.format_string(MEAN_TRIPS_LABEL, fixed("avg_daily_trips", 0)).alias("mean_line"),
    ]
    return overview.select(*cols)


def schema_profile(df: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """The schema as a table: ``pos``, ``column``, ``type``, ``nullable``."""
    session = spark or df.sparkSession
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    schema = T.StructType(
        [
            T.StructField("pos", T.IntegerType(), False),
            T.StructField("column", T.StringType(), False),
            T.StructField("type", T.StringType(), False),
            T.StructField("nullable", T.BooleanType(), False),
        ]
    )
    return session.createDataFrame(rows, schema)


def sample_rows(df: DataFrame, n: int = 5, order_by: list[str] | None = None) -> DataFrame:
    """First ``n`` rows; with ``order_by`` in a repeatable order.

    The top-k runs on the first sort key alone (one column is read); the
    other columns are then fetched for the rows up to its ``n``-th value, by a
    filter that reaches the scan, and only those are sorted by all keys.
    """
    if not order_by:
        return df.limit(n)
    key = F.col(order_by[0])
    smallest = [r[0] for r in df.select(key).orderBy(key).limit(n).collect()]
    if len(smallest) == n and n:
        edge = smallest[-1]
        df = df.where(key.isNull() if edge is None else key.isNull() | (key <= F.lit(edge)))
    return df.orderBy(*order_by).limit(n)


def to_pandas(df: DataFrame, max_rows: int):
    """``toPandas`` (Arrow batches) for a small result only.

    At most ``max_rows + 1`` rows are fetched; more than ``max_rows`` raises,
    so an unbounded result never lands on the driver.
    """
    pdf = df.limit(max_rows + 1).toPandas()
    if len(pdf) > max_rows:
        raise ValueError(f"result has more than {max_rows} rows; write it out instead")
    return pdf
