"""A small table that says what is published, kept as numbered versions.

Data is written to a folder of its own first; a row in the manifest is what
makes it visible. A version is one Parquet file, written whole or not at all,
so a run that is killed leaves the last version in force and its own data
unseen. Old versions stay readable. Every version holds one further row of
NULLs (``held`` false), so that one without rows is a file too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.sources.errors import ANALYSIS_ERROR, NOT_FOUND, classify_error


class Manifest:
    """Versions of one table under ``root``; ``fields`` is its schema as DDL."""

    def __init__(self, spark: SparkSession, root: str, fields: str) -> None:
        self.spark, self.root, self.fields = spark, root.rstrip("/"), fields

    def version(self) -> int:
        """The newest version, 0 if none was published."""
        try:
            versions = self.spark.read.schema("held boolean, version long").parquet(self.root)
            return versions.agg(F.max("version")).first()[0] or 0
        except Exception as exc:  # noqa: BLE001 - no manifest yet is an answer
            if classify_error(exc) in (NOT_FOUND, ANALYSIS_ERROR):
                return 0
            raise

    def rows(self, version: int | None = None) -> DataFrame:
        """The rows of a version (default: the newest)."""
        version = self.version() if version is None else version
        if not version:
            return self.spark.createDataFrame([], self.fields)
        rows = self.spark.read.schema(f"{self.fields}, held boolean").parquet(f"{self.root}/version={version}")
        return rows.where("held").drop("held")

    def publish(self, rows: DataFrame) -> int:
        """``rows`` as the next version, in one file; fails if another run has published it meanwhile."""
        version = self.version() + 1
        columns = self.spark.createDataFrame([], self.fields).schema
        mark = self.spark.range(1).select(
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in columns], F.lit(False).alias("held")
        )
        marked = rows.select(*columns.names, F.lit(True).alias("held")).union(mark).repartition(1)
        marked.write.mode("errorifexists").parquet(f"{self.root}/version={version}")
        return version
