"""Command line: the daily job, the activity job, the installation check, a source probe.

    python -m daybook.cli daily --root DATA --year 2021 --months 1-6 --out daily_averages.csv
    python -m daybook.cli activity --input comments/ --id-col id --out-dir . --mode cluster
    python -m daybook.cli check
    python -m daybook.cli probe s3a://bucket/a/*.parquet s3a://bucket/b/
    python -m daybook.cli ls s3a://bucket/b/
    python -m daybook.cli daily --root DATA --year 2021 --months 1-12 --states s3a://bucket/states
    python -m daybook.cli copy s3a://public/comments s3a://bucket/comments --where yyyy=2024
    python -m daybook.cli index DATA --ts tpep_pickup_datetime --out s3a://bucket/index

On a cluster leave ``--master`` out and pass it to ``spark-submit``. Extra
settings (object-store credentials provider, endpoint, ...) go in
``--conf key=value``. ``--input-gb N --total-cores C`` sizes scan splits and
shuffle partitions for the input (``session.scale_settings``); ``--auto-size``
does the same from the listed size of the input itself. Exit code 0 on success, 1 on failure.
"""

from __future__ import annotations

import argparse
import sys

from daybook import session
from daybook.operators.daily import TripColumns
from daybook.sinks.csv import DAILY_CSV


def _months(text: str) -> list[int]:
    out: list[int] = []
    for part in text.split(","):
        if "-" in part:
            a, b = part.split("-")
            out.extend(range(int(a), int(b) + 1))
        else:
            out.append(int(part))
    return out


def _conf(pairs: list[str]) -> dict[str, str]:
    conf = {}
    for p in pairs:
        k, _, v = p.partition("=")
        if not v:
            raise SystemExit(f"--conf needs key=value, got {p!r}")
        conf[k] = v
    return conf


def _auto_size(spark, args, paths: list[str]) -> None:
    """Size splits and shuffles from the input's listed bytes (``--auto-size``).

    Only file sizes are read (Spark lists the files; no contents). The
    settings are runtime SQL settings, so they apply to the job that follows;
    a setting given with ``--conf`` is left as given.
    """
    from functools import reduce

    from daybook.sources.listing import input_size, list_files

    files = reduce(lambda a, b: a.unionByName(b), [list_files(spark, p, recursive=True) for p in paths])
    total = int(input_size(files).first().total_bytes)
    cores = args.total_cores or spark.sparkContext.defaultParallelism
    given = _conf(args.conf)
    for key, value in session.scale_settings(total, cores).items():
        if key not in given:
            spark.conf.set(key, value)
    print(f"auto-size: {total / session.GB:.2f} GB over {cores} cores -> "
          f"{spark.conf.get('spark.sql.shuffle.partitions')} shuffle partitions, "
          f"{spark.conf.get('spark.sql.files.maxPartitionBytes')} byte splits")


def cmd_daily(spark, args) -> int:
    from daybook.plans.daily_job import run_daily, timed
    from daybook.sinks.report import overview_report
    from daybook.sources.files import TRIP_SCHEMA, month_paths, read_months

    if args.states:
        return _daily_from_states(spark, args)
    paths = args.paths or month_paths(args.root, args.year, _months(args.months or "1-6"))
    loaded = read_months(spark, paths, schema=TRIP_SCHEMA if args.declared_schema else None)
    for path, why in loaded.skipped:
        print(f"skipped {path}: {why}")
    for path, column in loaded.filled:
        print(f"no column {column} in {path}: NULL")
    cols = _columns(args)
    if args.auto_size:
        _auto_size(spark, args, loaded.read)
    if args.explore:
        _explore(spark, loaded, cols.ts)
    res = timed(
        lambda: run_daily(
            loaded.df, cols, year=args.year, out_csv=args.out, show_n=args.show, accuracy=args.accuracy, exact=args.exact
        )
    )
    if not res.ok:
        print(f"failed: {res.error}")
        return 1
    run = res.value
    run.first_rows.show(args.show, truncate=False)
    print(f"Rows read: {run.total_rows:,}")
    for line in overview_report(run.overview).first():
        if line is not None:
            print(line)
    for row in run.report.collect():
        print(row.text)
        print("-" * 40)
    print(f"Execution time: {res.seconds:.2f} seconds")
    if args.out:
        print(f"Saved to {args.out}")
    return 0


def _columns(args) -> TripColumns:
    return TripColumns(
        ts=args.ts, distance=args.distance, tax=args.tax, fare=args.fare, tip=args.tip, passengers=args.passengers
    )


def _daily_from_states(spark, args) -> int:
    """The daily run from stored month states: reads the months that are new or have changed."""
    from daybook.operators.daily import DAY_KEYS, daily_overview, newest_days
    from daybook.operators.states import MonthStates
    from daybook.plans.daily_job import timed
    from daybook.sinks.csv import write_small_csv
    from daybook.sinks.report import daily_report, overview_report
    from daybook.sources.files import TRIP_SCHEMA, month_paths

    months = _months(args.months or "1-6")
    inputs = {f"{args.year}-{m:02d}": [p] for m, p in zip(months, month_paths(args.root, args.year, months))}
    store = MonthStates(spark, args.states, _columns(args))

    def step():
        told = store.refresh(inputs, schema=TRIP_SCHEMA if args.declared_schema else None)
        daily = store.summary(args.year, ordered=False).checkpoint()  # at most 366 rows
        if args.out:
            from pyspark.sql import functions as F

            write_small_csv(daily, args.out, [F.col(k).desc() for k in DAY_KEYS], max_rows=None)
        return told, daily

    res = timed(step)
    if not res.ok:
        print(f"failed: {res.error}")
        return 1
    told, daily = res.value
    for path, why in told.skipped:
        print(f"skipped {path}: {why}")
    print(f"Months read: {', '.join(told.read) or 'none'}; from the store: {len(told.kept)}")
    newest_days(daily, args.show).show(args.show, truncate=False)
    for line in overview_report(daily_overview(daily)).first():
        if line is not None:
            print(line)
    for row in daily_report(daily, 5).collect():
        print(row.text)
        print("-" * 40)
    print(f"Execution time: {res.seconds:.2f} seconds")
    if args.out:
        print(f"Saved to {args.out}")
    return 0


def cmd_copy(spark, args) -> int:
    from daybook.plans.daily_job import timed
    from daybook.sources.copies import copy_new

    where = {k: int(v) if v.isdigit() else v for k, v in _conf(args.where).items()}
    res = timed(lambda: copy_new(spark, args.source, args.target, args.partition_by.split(","), where))
    if not res.ok:
        print(f"failed: {res.error}")
        return 1
    done = res.value
    for part in done.partitions:
        print(f"copied {part}")
    print(f"{len(done.partitions)} partitions, {done.files} of {done.files_total} files, {done.rows:,} rows")
    print(f"Execution time: {res.seconds:.2f} seconds")
    return 0


def cmd_index(spark, args) -> int:
    from pyspark.sql import functions as F

    from daybook.sources.index import index_files

    index = index_files(spark, args.roots, args.ts)
    n = index.agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.count(F.when(F.col("status") != "ok", 1)).alias("bad"), F.count(F.when(F.col("low").isNull(), 1)).alias("open"),
    ).first()
    if args.out:
        index.write.mode("overwrite").parquet(args.out)
    print(f"{n.files} files, {n.rows:,} rows, {n.bad} unreadable, {n.open} without bounds of {args.ts}")
    return 0 if n.files > n.bad else 1


def _explore(spark, loaded, ts: str) -> None:
    """The notebook's first look: input size, schema, raw rows, rows with date parts."""
    from functools import reduce

    from daybook.functions.time import with_date_parts
    from daybook.sinks.report import sample_rows, schema_profile
    from daybook.sources.listing import input_size, list_files

    files = reduce(lambda a, b: a.unionByName(b), [list_files(spark, p) for p in loaded.read])
    size = input_size(files).first()
    print(f"Input: {size.n_files} files, {size.total_mb} MB")
    for r in schema_profile(loaded.df).collect():
        print(f"  {r.column}: {r.type}{'' if r.nullable else ' not null'}")
    order = [ts, *[c for c in loaded.df.columns if c != ts]]  # all columns: only equal rows tie
    sample_rows(loaded.df, 5, order).show(truncate=False)
    dated = with_date_parts(loaded.df, ts).select(ts, "dt_year", "dt_month", "dt_day")
    sample_rows(dated, 5, [ts]).show(truncate=False)


def cmd_activity(spark, args) -> int:
    from daybook.plans.activity_job import run_activity
    from daybook.plans.daily_job import timed
    from daybook.sources.files import read_parquet

    if args.auto_size:
        _auto_size(spark, args, [args.input])
    df = read_parquet(spark, args.input)
    res = timed(
        lambda: run_activity(
            df,
            args.id_col,
            args.user_col,
            args.group_col,
            args.time_col,
            top_n=args.top,
            approx=args.approx,
            out_dir=args.out_dir,
            mode=args.mode,
        )
    )
    if not res.ok:
        print(f"failed: {res.error}")
        return 1
    run = res.value
    run.stats.show(truncate=False)
    run.top.show(args.top, truncate=False)
    run.hours.show(25, truncate=False)  # 24 hours, and rows without a time
    for stem, path in run.outputs.items():
        print(f"{stem}: {path}")
    print(f"Execution time: {res.seconds:.2f} seconds")
    return 0


def cmd_check(spark, args) -> int:
    from daybook.operators.basic import even_double, first_value, row_count, sequence, sql_count

    df = sequence(spark, 1000)
    n = first_value(row_count(df), "total_rows")
    total = first_value(sql_count(df, "test_table"), "total")
    kept = first_value(row_count(even_double(df)), "total_rows")
    print(f"Spark {spark.version}: range {n} rows, SQL count {total}, even rows doubled {kept}")
    for key in ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes"):
        print(f"{key}={spark.conf.get(key)}")
    return 0 if (n, total, kept) == (1000, 1000, 500) else 1


def cmd_probe(spark, args) -> int:
    from daybook.sources.listing import probe_sources

    rows = probe_sources(spark, args.paths, stop_at_first=not args.all).collect()
    for r in rows:
        print(f"{r.status:15s} {r.path} rows={r.rows} columns={r.n_columns} {r.error or ''}")
    return 0 if any(r.status == "ok" for r in rows) else 1


def cmd_ls(spark, args) -> int:
    from daybook.sources.listing import list_directory

    found = list_directory(spark, args.path, args.first)
    if not found.exists:
        print(f"{args.path}: not found")
        return 1
    print(f"{args.path}: {len(found.names) + found.rest} files")
    for name in found.names:
        print(f"  {name}")
    if found.rest:
        print(f"  ... and {found.rest} more")
    return 0


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="daybook")
    ap.add_argument("--master", default=None)
    ap.add_argument("--conf", action="append", default=[])
    ap.add_argument("--input-gb", type=float, help="input size; with --total-cores sizes splits and shuffles")
    ap.add_argument("--total-cores", type=int, help="executor cores of the cluster")
    ap.add_argument("--auto-size", action="store_true", help="size splits and shuffles from the listed input bytes")
    sub = ap.add_subparsers(dest="cmd", required=True)

    d = sub.add_parser("daily")
    d.add_argument("--root")
    d.add_argument("--paths", nargs="*")
    d.add_argument("--year", type=int, default=2021)
    d.add_argument("--months", help="months of --root, e.g. 1-6 (the default) or 1,3,5")
    defaults = TripColumns()
    for name in ("ts", "distance", "tax", "fare", "tip", "passengers"):
        d.add_argument(f"--{name}", default=getattr(defaults, name))
    d.add_argument("--out", default=DAILY_CSV)
    d.add_argument("--accuracy", type=int, default=10000)
    d.add_argument("--exact", action="store_true")
    d.add_argument("--declared-schema", action="store_true")
    d.add_argument("--show", type=int, default=20)
    d.add_argument("--explore", action="store_true", help="print input size, schema and sample rows first")
    d.add_argument("--states", help="folder of stored month states: only new and changed months are read")

    a = sub.add_parser("activity")
    a.add_argument("--input", required=True)
    a.add_argument("--id-col", required=True)
    a.add_argument("--user-col", default="author")
    a.add_argument("--group-col", default="subreddit")
    a.add_argument("--time-col", default="created_utc")
    a.add_argument("--top", type=int, default=10)
    a.add_argument("--approx", action="store_true")
    a.add_argument("--out-dir", default=".")
    a.add_argument("--mode", default="local", choices=["local", "cluster"])

    sub.add_parser("check")
    p = sub.add_parser("probe")
    p.add_argument("paths", nargs="+")
    p.add_argument("--all", action="store_true")

    ls = sub.add_parser("ls")
    ls.add_argument("path")
    ls.add_argument("--first", type=int, default=10)

    cp = sub.add_parser("copy")
    cp.add_argument("source")
    cp.add_argument("target")
    cp.add_argument("--partition-by", default="yyyy,mm")
    cp.add_argument("--where", action="append", default=[], help="partition value, e.g. yyyy=2024")

    ix = sub.add_parser("index")
    ix.add_argument("roots", nargs="+")
    ix.add_argument("--ts", default=defaults.ts)
    ix.add_argument("--out")

    args = ap.parse_args(argv)
    if args.cmd == "daily" and not (args.root or args.paths):
        ap.error("daily needs --root or --paths")
    if args.cmd == "daily" and args.paths and (args.root or args.months):
        ap.error("--paths names the files itself: leave out --root and --months")
    if args.cmd == "daily" and args.states and (args.paths or args.exact or args.explore):
        ap.error("--states works on the months of --root, without --exact and --explore")
    if (args.input_gb is None) != (args.total_cores is None) and not args.auto_size:
        ap.error("--input-gb and --total-cores go together")
    if args.input_gb is not None and args.total_cores is None:
        ap.error("--input-gb needs --total-cores")
    conf: dict[str, str] = {}
    if args.input_gb is not None:
        conf.update(session.scale_settings(int(args.input_gb * session.GB), args.total_cores))
    conf.update(_conf(args.conf))  # explicit settings win
    spark = session.build(f"daybook-{args.cmd}", conf, master=args.master)
    try:
        commands = {
            "daily": cmd_daily, "activity": cmd_activity, "check": cmd_check, "probe": cmd_probe, "ls": cmd_ls,
            "copy": cmd_copy, "index": cmd_index,
        }
        return commands[args.cmd](spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
