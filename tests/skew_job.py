"""Registered queries over inputs where one key holds half of all rows.

Usage: python tests/skew_job.py SF_DIR OUT_DIR

Writes skewed copies of ``lineitem`` and ``events`` under ``OUT_DIR`` (the
table, plus the same rows again with one day / user / type / hour), runs the
registered queries on them with the event log on (``OUT_DIR/events``), each
under its own job group, and prints one ``MATCH name`` or ``DIFF name`` line
per query after comparing with the registered DuckDB SQL on the same files.
Run by ``tests/test_skew.py`` in its own process, since the event log must be
switched on when the session starts.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

QUERIES = (
    "daily_summary",
    "daily_summary_exact",
    "daily_overview",
    "top_groups",
    "top_categories",
    "hourly_counts",
    "peak_hour",
    "dataset_stats",
    "distinct_count_nulls",
)
HOT_TS = "1995-06-15 10:30:00"
HOT_USER = 7
HOT_TYPE = "click"
FILES = 8


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return repr(v)


def _split(cols, rows, skip=()):
    """``{non-float values: float values}``, columns in name order.

    Double means are compared with a relative tolerance: the files of the
    skewed copy are read in another order than the single test file, and a
    mean that is an exact decimal tie at its rounding digit then rounds
    either way depending on the last bit of the float sum.
    """
    order = [i for i in sorted(range(len(cols)), key=lambda i: cols[i]) if cols[i] not in skip]
    out = {}
    for r in rows:
        key = tuple(_norm(r[i]) for i in order if not isinstance(r[i], float))
        out[key] = tuple(r[i] for i in order if isinstance(r[i], float))
    return out


def _same(s_cols, s_rows, d_cols, d_rows, skip=()) -> bool:
    if sorted(s_cols) != sorted(d_cols) or len(s_rows) != len(d_rows):
        return False
    a, b = _split(s_cols, s_rows, skip), _split(d_cols, d_rows, skip)
    if a.keys() != b.keys():
        return False
    return all(
        len(a[k]) == len(b[k])
        and all(
            (math.isnan(x) and math.isnan(y)) or math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9)
            for x, y in zip(a[k], b[k])
        )
        for k in a
    )


def _q95_within_bound(con, rows) -> bool:
    """``percentile_approx`` guarantee: the value's rank is within n / accuracy of the target rank."""
    import pandas as pd

    got = pd.DataFrame(
        [(r["dt_year"], r["dt_month"], r["dt_day"], r["q95_fare_amount"]) for r in rows],
        columns=["y", "m", "d", "q"],
    )
    con.register("approx_q", got)
    days, bad = con.execute(
        """
        WITH ranks AS (
          SELECT a.y, a.m, a.d, count(*) AS n,
                 count(*) FILTER (WHERE l.l_extendedprice < a.q) AS below,
                 count(*) FILTER (WHERE l.l_extendedprice <= a.q) AS at_or_below
          FROM approx_q a JOIN lineitem l
            ON year(l.l_shipdate) = a.y AND month(l.l_shipdate) = a.m AND day(l.l_shipdate) = a.d
          GROUP BY 1, 2, 3)
        SELECT count(*) AS days,
               count(*) FILTER (WHERE greatest(below + 1 - ceil(0.95 * n), ceil(0.95 * n) - at_or_below, 0)
                                      > ceil(n / 10000.0)) AS bad
        FROM ranks
        """
    ).fetchone()
    return days == len(rows) and bad == 0


def main() -> None:
    sf_dir, out = sys.argv[1], sys.argv[2]
    events_dir = os.path.join(out, "events")
    os.makedirs(events_dir, exist_ok=True)

    import duckdb
    from pyspark.sql import functions as F

    from daybook import session
    from daybook.plans.registry import ORACLE_SQL
    from daybook.plans.registry import QUERIES as REGISTERED

    spark = session.build(
        "daybook-skew",
        {
            "spark.sql.shuffle.partitions": "8",
            "spark.sql.session.timeZone": "UTC",
            "spark.ui.showConsoleProgress": "false",
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": events_dir,
        },
        master="local[4]",
    )
    spark.sparkContext.setLogLevel("ERROR")

    hot_ts = F.lit(HOT_TS).cast("timestamp_ntz")
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    li.unionByName(li.withColumn("l_shipdate", hot_ts)).repartition(FILES).write.parquet(f"{out}/lineitem.parquet")
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    hot = ev.withColumns({"user_id": F.lit(HOT_USER).cast("bigint"), "event_type": F.lit(HOT_TYPE), "ts": hot_ts})
    ev.unionByName(hot).repartition(FILES).write.parquet(f"{out}/events.parquet")

    con = duckdb.connect()
    for t in ("lineitem", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{out}/{t}.parquet/*.parquet')")

    for name in QUERIES:
        spark.sparkContext.setJobGroup(name, name)
        df = REGISTERED[name](spark, out)
        collected = df.collect()
        spark.sparkContext.setJobGroup("other", "other")
        rows = [tuple(r) for r in collected]
        rel = con.execute(ORACLE_SQL[name])
        d_cols = [c[0] for c in rel.description]
        if name == "daily_summary":
            # Approximate percentile: exact for small groups, within its
            # documented rank error for the hot day.
            same = _same(df.columns, rows, d_cols, rel.fetchall(), skip=("q95_fare_amount",))
            same = same and _q95_within_bound(con, collected)
        else:
            same = _same(df.columns, rows, d_cols, rel.fetchall())
        print(f"{'MATCH' if same else 'DIFF'} {name}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
