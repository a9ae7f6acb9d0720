"""Registered daily and activity queries against their DuckDB SQL on generated tables.

Hypothesis builds small ``lineitem``-shaped tables (timestamps around the
kept year's edges and a leap day, NULL timestamps and values, NaN in the
max/min columns, repeated and negative values) and ``events``-shaped ones
(few users and types so counts tie, NULL keys and times, times before 1970
and at hour edges, repeated ids). Each table is written with
pyarrow (naive timestamps, read by Spark as TIMESTAMP_NTZ like the supplied
tables) and the registered query and its SQL run on it. Doubles compare with
a relative tolerance (see ``tests/skew_job.py``).
"""

from __future__ import annotations

import datetime as dt
import math

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry
from daybook.plans import registry
from tests.skew_job import _same

QUERIES = (
    "daily_summary",
    "daily_summary_exact",
    "daily_all_years",
    "daily_first_half",
    "daily_top20",
    "daily_overview",
    "daily_report",
    "overview_report",
    "month_subset",
    "year_filter_count",
    "year_function_count",
    "date_parts",
    "raw_sample",
)

DAYS = [
    dt.datetime(1994, 12, 31, 23, 59, 59),
    dt.datetime(1995, 1, 1, 0, 0, 0),
    dt.datetime(1995, 1, 1, 12, 30, 0),
    dt.datetime(1995, 2, 28, 8, 0, 0),
    dt.datetime(1995, 6, 30, 23, 59, 59),
    dt.datetime(1995, 7, 1, 0, 0, 0),
    dt.datetime(1995, 12, 31, 23, 59, 59),
    dt.datetime(1996, 1, 1, 0, 0, 0),
    dt.datetime(1996, 2, 29, 6, 0, 0),
]

prices = st.sampled_from([0.0, 1.5, 2.25, 100.0, 99999.99, -3.5, 42.42])
maybe = lambda s: st.one_of(st.none(), s)
with_nan = st.one_of(prices, st.just(math.nan))
rows = st.lists(
    st.tuples(
        maybe(st.sampled_from(DAYS)),
        maybe(prices),  # l_extendedprice: mean and percentile
        maybe(with_nan),  # l_tax: max
        maybe(with_nan),  # l_discount: min
        maybe(st.sampled_from([1.0, 2.0, 3.0, 7.5, 50.0])),  # l_quantity: ceil of mean
    ),
    min_size=1,
    max_size=60,
)


def _write(path, table_rows) -> None:
    cols = list(zip(*table_rows))
    t = pa.table(
        {
            "l_orderkey": pa.array(range(len(table_rows)), pa.int64()),
            "l_partkey": pa.array([1] * len(table_rows), pa.int64()),
            "l_suppkey": pa.array([1] * len(table_rows), pa.int64()),
            "l_linenumber": pa.array([1] * len(table_rows), pa.int32()),
            "l_quantity": pa.array(cols[4], pa.float64()),
            "l_extendedprice": pa.array(cols[1], pa.float64()),
            "l_discount": pa.array(cols[3], pa.float64()),
            "l_tax": pa.array(cols[2], pa.float64()),
            "l_returnflag": pa.array(["N"] * len(table_rows), pa.string()),
            "l_linestatus": pa.array(["O"] * len(table_rows), pa.string()),
            "l_shipdate": pa.array(cols[0], pa.timestamp("us")),
        }
    )
    pq.write_table(t, path)


@pytest.fixture(scope="module")
def counter():
    return iter(range(10_000))


# No shrinking: each step would run Spark jobs; the failing table is reported as generated.
@settings(
    max_examples=12,
    deadline=None,
    phases=[Phase.explicit, Phase.reuse, Phase.generate],
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(table_rows=rows)
def test_daily_queries_match_sql(spark, tmp_path_factory, counter, table_rows):
    out = tmp_path_factory.mktemp(f"fuzz{next(counter)}")
    _write(str(out / "lineitem.parquet"), table_rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{out}/lineitem.parquet')")
    for name in QUERIES:
        df = entry.queries()[name](spark, str(out))
        got = [tuple(r) for r in df.collect()]
        rel = con.execute(entry.oracle_sql()[name])
        d_cols = [c[0] for c in rel.description]
        assert _same(df.columns, got, d_cols, rel.fetchall()), (name, table_rows)


ACTIVITY_QUERIES = (
    "dataset_stats",
    "distinct_values",
    "distinct_count_nulls",
    "top_groups",
    "top_categories",
    "hourly_counts",
    "peak_hour",
)

TIMES = [
    dt.datetime(1969, 12, 31, 23, 59, 59),
    dt.datetime(1970, 1, 1, 0, 0, 0),
    dt.datetime(2024, 1, 1, 0, 0, 0),
    dt.datetime(2024, 1, 1, 0, 59, 59),
    dt.datetime(2024, 1, 15, 13, 0, 1),
    dt.datetime(2024, 1, 31, 23, 30, 0),
]

events = st.lists(
    st.tuples(
        maybe(st.integers(0, 30)),  # event_id, repeats allowed
        maybe(st.sampled_from(TIMES)),
        maybe(st.integers(1, 12)),  # user_id: few users, many ties
        maybe(st.sampled_from(["click", "view", "error", "buy"])),
    ),
    min_size=1,
    max_size=60,
)


def _write_events(path, table_rows) -> None:
    cols = list(zip(*table_rows))
    t = pa.table(
        {
            "event_id": pa.array(cols[0], pa.int64()),
            "ts": pa.array(cols[1], pa.timestamp("us")),
            "user_id": pa.array(cols[2], pa.int64()),
            "event_type": pa.array(cols[3], pa.string()),
            "value": pa.array([1.0] * len(table_rows), pa.float64()),
            "props": pa.array(["{}"] * len(table_rows), pa.string()),
        }
    )
    pq.write_table(t, path)


# No shrinking: each step would run Spark jobs; the failing table is reported as generated.
@settings(
    max_examples=12,
    deadline=None,
    phases=[Phase.explicit, Phase.reuse, Phase.generate],
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(table_rows=events)
def test_activity_queries_match_sql(spark, tmp_path_factory, counter, table_rows):
    out = tmp_path_factory.mktemp(f"fuzz_ev{next(counter)}")
    _write_events(str(out / "events.parquet"), table_rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{out}/events.parquet')")
    for name in ACTIVITY_QUERIES:
        df = entry.queries()[name](spark, str(out))
        got = [tuple(r) for r in df.collect()]
        rel = con.execute(entry.oracle_sql()[name])
        d_cols = [c[0] for c in rel.description]
        assert _same(df.columns, got, d_cols, rel.fetchall()), (name, table_rows)


def test_empty_tables_match_sql(spark, tmp_path):
    # Every registered query on empty tables with the supplied schemas.
    con = duckdb.connect()
    for t in ("lineitem", "events", "orders"):
        schema = pq.read_schema(f"/root/testdata/sf0.001/{t}.parquet").remove_metadata()
        pq.write_table(schema.empty_table(), str(tmp_path / f"{t}.parquet"))
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet')")
    for name, q in registry.QUERIES.items():
        df = q(spark, str(tmp_path))
        got = [tuple(r) for r in df.collect()]
        rel = con.execute(registry.ORACLE_SQL[name])
        d_cols = [c[0] for c in rel.description]
        assert _same(df.columns, got, d_cols, rel.fetchall()), name
