"""Parquet inputs: monthly files, hive-partitioned trees, staging copies.

Reading is lazy: the driver only reads footers (schemas); rows are read by
the executors when an action runs, with column pruning and pushed filters.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.sources.errors import OK, UNEXPECTED, classify_error, label_of
from daybook.sources.footers import READ, opens, read_footers
from daybook.sources.tree import list_tree

# Parquet read options Spark understands (data source and file-source options).
PARQUET_OPTIONS = frozenset(
    {
        "mergeSchema",
        "pathGlobFilter",
        "recursiveFileLookup",
        "modifiedBefore",
        "modifiedAfter",
        "basePath",
        "datetimeRebaseMode",
        "int96RebaseMode",
        "ignoreCorruptFiles",
        "ignoreMissingFiles",
    }
)

# Of these, the ones that choose files.
LISTING_OPTIONS = frozenset({"pathGlobFilter", "recursiveFileLookup", "modifiedBefore", "modifiedAfter"})

# Footer (schema) reads run this many at a time on the driver.
SCHEMA_READERS = 16

# Up to so many paths and files a Spark job for their footers costs more than it saves.
FEW_FILES = 32

# The input column names of the trip and comment tables and the
# monthly trip file layout. Types follow from how each column is used.
TRIP_SCHEMA = T.StructType(
    [
        T.StructField("tpep_pickup_datetime", T.TimestampType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("mta_tax", T.DoubleType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("passenger_count", T.DoubleType()),
    ]
)

COMMENT_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("subreddit", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("created_utc", T.LongType()),
    ]
)

TRIP_TEMPLATE = "{root}/yyyy={year}/yellow_tripdata_{year}-{month:02d}.parquet"


def month_paths(root: str, year: int, months: Iterable[int], template: str = TRIP_TEMPLATE) -> list[str]:
    """One path per month, zero-padded month in the name, in the given order."""
    out = []
    for m in months:
        if not 1 <= int(m) <= 12:
            raise ValueError(f"month {m} outside 1..12")
        out.append(template.format(root=root.rstrip("/"), year=year, month=int(m)))
    return out


def check_options(options: Mapping[str, object]) -> dict[str, str]:
    """Reject options the parquet reader does not know (e.g. ``header``).

    Spark ignores unknown options silently; a typo or a CSV-only option then
    changes nothing without a word.
    """
    known = {k.lower() for k in PARQUET_OPTIONS}  # Spark matches option names in any case
    unknown = sorted(k for k in options if k.lower() not in known)
    if unknown:
        raise ValueError(f"not parquet read options: {', '.join(unknown)}")
    return {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in options.items()}


def read_parquet(spark: SparkSession, *paths: str, **options: object) -> DataFrame:
    """``spark.read.parquet`` with option names checked first."""
    if not paths:
        raise ValueError("no paths given")
    return spark.read.options(**check_options(options)).parquet(*paths)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project onto a declared schema: cast present columns, NULL for missing ones.

    Extra columns are dropped; the column order is the declared one.
    """
    present = {f.name: f.dataType for f in df.schema.fields}
    cols: list[Column] = []
    for f in schema.fields:
        if f.name in present:
            c = F.col(f.name)
            cols.append((c if present[f.name] == f.dataType else c.cast(f.dataType)).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


@dataclass
class Loaded:
    """A combined input plus what was left out and why."""

    df: DataFrame
    read: list[str]
    skipped: list[tuple[str, str]] = field(default_factory=list)
    filled: list[tuple[str, str]] = field(default_factory=list)  # (path, declared column it lacks)


class NothingRead(FileNotFoundError):
    """No path could be read; ``skipped`` names them with their labels."""

    def __init__(self, skipped: list[tuple[str, str]]) -> None:
        super().__init__(f"none of {len(skipped)} paths could be read: {skipped}")
        self.skipped = skipped


def read_months(
    spark: SparkSession,
    paths: Sequence[str],
    schema: T.StructType | None = None,
    tolerant: bool = True,
    few: int = FEW_FILES,
    **options: object,
) -> Loaded:
    """Read many monthly Parquet paths as one table, safely.

    * tolerant: whatever cannot be read (missing, denied, a damaged footer,
      ...) is skipped and reported with its label: a path, or a single file of
      a directory. With nothing left it raises ``FileNotFoundError``. With
      ``tolerant=False`` the first failure is raised as is.
    * drift-safe: files, also those of one directory, are grouped by their
      footer schema and each group is one scan; groups are cast to ``schema``
      (when given) and combined with ``unionByName(allowMissingColumns=True)``.
      So an INT/BIGINT drift or an extra column in one file does not fail the
      job at run time. Scans stay one per distinct schema, not one per file.
    * beyond ``few`` paths or files, executors list the paths and read the
      footers (``footers``, ``tree``); the driver reads one schema per distinct
      footer. Up to ``few``, and for schemes that tasks do not open, the driver
      reads them, ``SCHEMA_READERS`` at a time. The result is the same.
    * declared columns that a file lacks are NULL there and listed in
      ``filled``; one that no file has raises ``ValueError``.
    """
    opts = check_options(options)

    def attempt(step):
        try:
            return step()
        except Exception as exc:  # noqa: BLE001 - reported by label, or raised below
            return exc

    def files_of(path: str) -> list[tuple[str, str | None]]:
        """A path's files, each with the root that its partition columns count from."""
        files = spark.read.format("binaryFile").options(**{k: v for k, v in opts.items() if k in LISTING_OPTIONS})
        inputs = sorted(unquote(f) for f in files.load(path).inputFiles())  # URIs; paths are given unescaped
        if not inputs:  # an empty directory: let the Parquet reader say so
            return [(path, None)]
        return [(f, None if is_file(path, f) else path) for f in inputs if is_data(f)] or [(path, None)]

    def footer_schema(file: str, root: str | None) -> T.StructType:
        reader = spark.read.options(**opts)
        return (reader.option("basePath", root) if root and not is_glob(root) else reader).parquet(file).schema

    chosen = {o.lower() for o in LISTING_OPTIONS} & {o.lower() for o in opts}
    by_tasks = not chosen and all(opens(p) for p in paths)
    with ThreadPoolExecutor(max_workers=SCHEMA_READERS) as pool:
        listed = None
        if by_tasks and len(paths) > few and not any(map(is_glob, paths)):
            listed = _listed_by_tasks(spark, paths)
        if listed is None:
            # Listings are round trips to storage: a few at a time, results in path order.
            listed = list(pool.map(lambda p: attempt(lambda: files_of(p)), paths))
        every = [f for files in listed if not isinstance(files, Exception) for f, _ in files]
        told = None
        if by_tasks and len(every) > few:
            told = _schemas_by_tasks(spark, every, lambda f: attempt(lambda: footer_schema(f, None)))
        if told is None:
            pairs = [x for files in listed if not isinstance(files, Exception) for x in files]
            told = dict(zip([f for f, _ in pairs], pool.map(lambda x: attempt(lambda: footer_schema(*x)), pairs)))

    groups: dict[tuple[str, str | None], list[str]] = {}
    skipped: list[tuple[str, str]] = []
    filled: list[tuple[str, str]] = []
    read: list[str] = []
    n_files = 0
    for p, files in zip(paths, listed):
        if isinstance(files, Exception):
            if not tolerant:
                raise files
            skipped.append((p, classify_error(files)))
            continue
        good: dict[tuple[str, str | None], list[str]] = {}
        for f, root in files:
            footer = told[f]
            if isinstance(footer, Exception):
                if not tolerant:
                    raise footer
                skipped.append((p if len(files) == 1 else f, classify_error(footer)))
                continue
            n_files += 1
            good.setdefault((footer.json(), root), []).append(f)
            if schema is not None:
                lacking = sorted({c.name for c in schema.fields} - set(footer.fieldNames()) - partition_names(f, root))
                filled += [(p if len(files) == 1 else f, c) for c in lacking]
        if good:
            read.append(p)
        for key, fs in good.items():
            # A directory of one schema without a bad file is read as one path: Spark lists it in one step.
            whole = len(fs) == len(files) and key[1] is not None and not is_glob(p)
            groups.setdefault(key, []).extend([p] if whole else fs)
    if not groups:
        raise NothingRead(skipped)
    if schema is not None:
        nowhere = [c for c in schema.fieldNames() if sum(c == name for _, name in filled) == n_files]
        if nowhere:
            raise ValueError(f"no file has the declared column(s) {', '.join(nowhere)}")

    return Loaded(combined(spark, groups, schema, opts), read, skipped, filled)


def combined(
    spark: SparkSession,
    groups: Mapping[tuple[str, str | None], Sequence[str]],
    schema: T.StructType | None,
    options: Mapping[str, str],
) -> DataFrame:
    """One scan per group (kind of schema, root of the partition columns), cast to ``schema`` and put together by name."""
    parts = []
    for (_, root), files in groups.items():
        reader = spark.read.options(**options)
        part = (reader.option("basePath", root) if root and not is_glob(root) else reader).parquet(*files)
        parts.append(conform(part, schema) if schema is not None else part)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


class Unreadable(Exception):
    """What a task reported of a path: the label leads the message."""


def _listed_by_tasks(spark: SparkSession, paths: Sequence[str]) -> list | None:
    """Per path its files with their root, or the failure, listed by executors; None if they can't list any."""
    found: dict[str, list] = {}
    for r in list_tree(spark, paths).orderBy("path").toLocalIterator():
        failed = r.status != OK
        found.setdefault(r.root, []).append(Unreadable(f"{r.status}: {r.error}") if failed else (r.path, r.root))
    listed = []
    for p in paths:
        entries = found.get(p, [(p, None)])  # an empty directory: let the Parquet reader say so
        bad = [e for e in entries if isinstance(e, Unreadable)]
        own = entries == [(p, p)]
        listed.append(bad[0] if bad else [(p, None)] if own else entries)
    return None if all(isinstance(x, Exception) and classify_error(x) == UNEXPECTED for x in listed) else listed


def _schemas_by_tasks(spark: SparkSession, files: list[str], schema_of: Callable) -> dict | None:
    """File -> its schema or failure; footers are read by executors, one file of each kind by the driver.

    None if the executors can read none (no library or no rights for the scheme there).
    """
    rows = {r.path: r for r in read_footers(spark, files).select("path", "status", "error", "signature").collect()}
    first: dict[str, str] = {}
    for f in files:
        if rows[f].status == READ:
            first.setdefault(rows[f].signature, f)
    if not first:
        return None
    schemas = {s: schema_of(f) for s, f in first.items()}
    failed = lambda r: Unreadable(f"{label_of(r.error)}: {r.error}")
    return {f: schemas[r.signature] if r.status == READ else failed(r) for f, r in rows.items()}


def partition_names(file: str, root: str | None) -> set[str]:
    """Names of the partition directories between a root and a file."""
    inside = file.split("/" + root.split(":", 1)[-1].strip("/") + "/", 1)[-1] if root else ""
    return {part.split("=", 1)[0] for part in inside.split("/")[:-1] if "=" in part}


def is_glob(path: str) -> bool:
    return any(c in path for c in "*?[{")


def is_file(path: str, file: str) -> bool:
    """Whether a listed file is the asked path itself (listings carry a scheme)."""
    return file.rstrip("/").endswith(path.rstrip("/").split(":", 1)[-1].lstrip("/"))


def is_data(file: str) -> bool:
    """Names that begin with a dot or underscore are no data files, as in Spark's own listing."""
    return not file.rstrip("/").rsplit("/", 1)[-1].startswith((".", "_"))


def read_partitioned(
    spark: SparkSession,
    root: str,
    where: Mapping[str, object] | None = None,
    schema: T.StructType | None = None,
    **options: object,
) -> DataFrame:
    """Read a hive-partitioned tree (``yyyy=2024/mm=01/...``) from its root.

    Reading the root keeps the partition columns; equality filters on them
    become ``PartitionFilters`` so only the matching directories are listed
    and read. A ``schema`` (partition columns included) lets an empty tree be read.
    """
    if schema is not None:
        df = spark.read.options(**check_options(options)).schema(schema).parquet(root)
    else:
        df = read_parquet(spark, root, **options)
    for k, v in (where or {}).items():
        df = df.where(F.col(k) == F.lit(v))
    return df


def read_leaf(spark: SparkSession, root: str, leaf: str, **options: object) -> DataFrame:
    """Read one partition directory but keep the partition columns (``basePath``)."""
    return read_parquet(spark, leaf, basePath=root, **options)


def stage(
    spark: SparkSession,
    src_root: str,
    dst_root: str,
    where: Mapping[str, object],
    partition_by: Sequence[str] = ("yyyy", "mm"),
) -> DataFrame:
    """Copy selected partitions of a hive tree into our own storage.

    Executors read and write in parallel. ``dynamic`` partition overwrite
    replaces only the partitions being written, so a rerun after a failure
    rewrites the same partitions and leaves the others alone. Directories
    keep their names: partition values are written as they stand in the
    source's paths (``mm=01`` stays ``mm=01``), not as the numbers that Spark
    reads them as. Returns the staged partitions as read back from
    ``dst_root``; with no matching partition nothing is written and the
    result is empty.
    """
    df = read_partitioned(spark, src_root, where)
    names = {k: F.regexp_extract(F.col("_metadata.file_path"), f"/{k}=([^/]*)/", 1) for k in partition_by}
    df = df.withColumns({k: F.url_decode(F.replace(v, F.lit("+"), F.lit("%2B"))) for k, v in names.items()})
    if df.isEmpty():
        return read_partitioned(spark, src_root, where)
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(dst_root)
    )
    return read_partitioned(spark, dst_root, where)
