"""Session construction and the settings this library relies on.

Operators never change session settings; only ``build`` (for scripts and
tests) and the bench set them. On a cluster the master comes from
``spark-submit --master``, object-store settings (``spark.hadoop.fs.s3a.*``)
are passed in ``conf`` like any other setting.
"""

from __future__ import annotations

import math
import os
import tempfile
from collections.abc import Mapping

from pyspark.sql import SparkSession

# Defaults used when the caller does not give a value.
DEFAULTS: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A year has up to 366 day groups; above 128 keys per task the object
    # aggregate (percentile sketch) falls back to sort-based aggregation.
    # Sketches live outside Spark's managed memory: one holds at most its
    # key's rows in the task and compresses to ~100 KB at accuracy 10,000
    # (250k values measured at 108 KB), so 4,096 keys bound a task's buffers
    # near 400 MB. Past 4,096 keys the sort-based path (spillable) takes over.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
    "spark.ui.enabled": "false",
    # Checkpoint files of results that are no longer referenced are deleted.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

MB = 1024 * 1024
GB = 1024 * MB


def scale_settings(
    input_bytes: int,
    total_cores: int,
    split_bytes: int = 512 * MB,
    shuffle_partition_bytes: int = 1 * GB,
    advisory_bytes: int = 256 * MB,
) -> dict[str, str]:
    """Scan and shuffle sizes for a run over ``input_bytes`` of Parquet on ``total_cores`` cores.

    * Scan splits of ``split_bytes`` (never fewer than one split per core):
      each scan task's partial aggregate emits one buffer per key, so fewer,
      larger splits also mean fewer buffers shuffled (for the daily summary,
      percentile sketches).
    * Shuffle partitions sized for the largest shuffle: an exact distinct
      count of a near-unique id moves about one row per input row, so the
      count is the input size over ``shuffle_partition_bytes`` (at least two
      per core), which keeps a reduce task's share within executor memory
      at every input size and lets it spill in bounded pieces.
    * AQE starts from that count and merges the partitions of the small
      shuffles (daily and hourly buffers, top-k counts) up to
      ``advisory_bytes``, so they do not run as many tiny tasks.
    """
    if input_bytes < 0 or total_cores <= 0:
        raise ValueError("need input_bytes >= 0 and total_cores > 0")
    split = min(split_bytes, max(4 * MB, math.ceil(input_bytes / total_cores)))
    partitions = max(2 * total_cores, math.ceil(input_bytes / shuffle_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(advisory_bytes),
    }


def build(
    app: str = "daybook",
    conf: Mapping[str, str] | None = None,
    master: str | None = None,
) -> SparkSession:
    """Get or create a session with ``DEFAULTS`` under the given ``conf``.

    ``master=None`` leaves the master to ``spark-submit`` (cluster runs).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULTS)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use ``spark.checkpoint.dir``; only in local mode with it unset (tests) make one.

    A machine-local folder is never used on a cluster: lost executors must
    find checkpoints on shared storage.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="daybook-ckpt-")
    sc.setCheckpointDir(configured)
    return configured


def importable(spark: SparkSession) -> None:
    """Let Python tasks import this package where the driver found it through its own ``sys.path`` (local sessions).

    On a cluster it is installed or shipped with ``--py-files``; the extra entry is harmless there.
    """
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if PACKAGE_ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*filter(None, paths), PACKAGE_ROOT])
