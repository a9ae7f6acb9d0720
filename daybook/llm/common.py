"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.session import ensure_checkpoint_dir

PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
BUCKET_BITS = 20  # of in_buckets: at most 1M numbers (8 MB) are broadcast
TEXT_PER_CHUNK = 8_000_000  # bytes of text handled at once in a task: bounds a worker's memory


def col(name: str) -> Column:
    """A top-level column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def kept(df: DataFrame, by: str | None = None) -> DataFrame:
    """``df`` written once as Parquet in the shared checkpoint folder and read back.

    Cuts the lineage: a lost executor does not recompute what led here, and a
    second use does not either. Compressed, so smaller than ``checkpoint()``;
    used where a row holds more than a few numbers. ``by`` names a column to
    partition the files by.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/kept-{uuid.uuid4().hex}"
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def in_buckets(rows: DataFrame, wanted: DataFrame, key: str, how: str = "left_semi") -> DataFrame:
    """Rows whose bucket holds a key of ``wanted`` (or holds none: ``left_anti``).

    A filter before a shuffle of wide rows: it lets some other rows through,
    drops none that are wanted, and broadcasts at most 2**BUCKET_BITS numbers
    however many keys there are.
    """
    bucket = F.shiftrightunsigned(F.xxhash64(key), 64 - BUCKET_BITS)
    held = wanted.select(bucket.alias("_bucket")).distinct()
    return rows.withColumn("_bucket", bucket).join(F.broadcast(held), "_bucket", how).drop("_bucket")


def arrow_schema(fields: str) -> pa.Schema:
    """``"doc_id long, spans string"`` as an Arrow schema (the few types used here)."""
    kinds = {
        "long": pa.int64(),
        "int": pa.int32(),
        "double": pa.float64(),
        "string": pa.string(),
        "binary": pa.binary(),
        "boolean": pa.bool_(),
        "array<int>": pa.list_(pa.int32()),
        "array<long>": pa.list_(pa.int64()),
        "array<string>": pa.list_(pa.string()),
    }
    pairs = [f.strip().split(" ", 1) for f in fields.split(",")]
    return pa.schema([(name, kinds[kind.strip()]) for name, kind in pairs])


def slices(
    batches: Iterable[pa.RecordBatch], text: int, most: int = TEXT_PER_CHUNK, length: Callable = pc.binary_length
) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the bytes of a slice's texts (column ``text``) stay near ``most``.

    A single longer text is a slice of its own: texts are never cut.
    """
    for batch in batches:
        n, start, size = batch.num_rows, 0, 0
        lengths = pc.fill_null(length(batch.column(text)), 0).to_pylist()
        for i in range(n):
            if size and size + lengths[i] > most:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += lengths[i]
        if n > start:
            yield batch.slice(start)


def chunks(batches: Iterable[pa.RecordBatch], text: int = 1, most: int = TEXT_PER_CHUNK) -> Iterator[list[list]]:
    """The rows of the batches' ``slices`` as lists of columns."""
    for part in slices(batches, text, most):
        yield [c.to_pylist() for c in part.columns]


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def map_arrow(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``df.mapInArrow``, with this package importable in the tasks.

    A driver that found the package through its own ``sys.path`` tells the
    workers where it lies (local sessions); on a cluster it is installed or
    shipped with ``--py-files`` and the extra entry is harmless.
    """
    env = df.sparkSession.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if PACKAGE_ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*filter(None, paths), PACKAGE_ROOT])
    return df.mapInArrow(run, schema)


def map_rows(docs: DataFrame, text: str, run: Callable) -> DataFrame:
    """``docs`` through ``run`` over Arrow batches whose first column is the text; columns and order stay.

    Columns travel under plain names, so that any name is allowed. Batches are cut by their texts' bytes (``slices``),
    so that a worker's memory does not grow with the length of the rows that Spark puts into one batch.
    """
    names = docs.columns
    order = [text, *[c for c in names if c != text]]
    plain = docs.select(*[col(c).alias(f"c{i}") for i, c in enumerate(order)])
    out = map_arrow(plain, lambda batches: run(slices(batches, 0)), plain.schema)
    return out.select(*[F.col(f"c{order.index(c)}").alias(c) for c in names])


def map_texts(df: DataFrame, work: Callable[..., list], fields: str) -> DataFrame:
    """``work(*columns)`` over chunks of rows; the second column is the text. ``work`` returns output columns."""
    schema = arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in chunks(batches):
            out = work(*columns)
            arrays = [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(out, schema)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return map_arrow(df, run, fields)
