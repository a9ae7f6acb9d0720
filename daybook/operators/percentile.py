"""Exact discrete percentile per group, one method for groups of every size.

``percentile_disc`` (and a window over a whole group) puts every value of a
group into one task; when one key holds a third of all rows, that task holds
a third of the table. Here:

1. one aggregation counts each group's values and reads a band ``[lo, hi]``
   around the wanted share off a ``percentile_approx`` sketch (mergeable,
   bounded memory, combined map-side);
2. a second pass counts the rows below the band and, inside it, the rows of
   each value; the result holds a few values per group, pre-aggregated
   before its shuffle on (group, value), and is checkpointed;
3. a cumulative count over these finds the value at the wanted rank: in one
   window per group while every group has counted few values (``window_values``
   at most, known from the counts), beyond it in two levels (sums per range of
   values, then inside a range), so no task needs a whole group here either.
   Both give the same answer.

The band comes from a sketch but the answer does not: the counted rows tell
whether the wanted rank lies inside the band. For a group where it does not,
the band is widened to all its values and step 2 runs again for such groups
alone: two reads of the input, three at most.

Groups are matched NULL-safely: a NULL key is a group like any other.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.session import ensure_checkpoint_dir

BROADCAST_ROWS = 200_000
SALTS = 32
WINDOW_VALUES = 200_000  # counted values of a group that one window sorts
MARGIN = 2  # half width of the band, in errors of the sketch


def rank_target(p: float, n: Column) -> Column:
    """1-based rank of the discrete ``p`` percentile among ``n`` values.

    DECIMAL arithmetic, so that e.g. ``0.07 * 100`` is 7, not 7.000000000000001.
    """
    if not 0.0 <= p <= 1.0:
        raise ValueError(f"percentile {p} outside [0, 1]")
    share = Decimal(repr(float(p)))
    if share != round(share, 10):
        raise ValueError(f"percentile {p} has more than 10 decimals")
    prod = F.lit(share).cast("decimal(20,10)") * n.cast("decimal(20,0)")
    return F.greatest(F.lit(1), F.ceil(prod)).cast("bigint")


def band(value: str, p: float, accuracy: int) -> list[Column]:
    """Aggregates that ``exact_percentile`` takes as ``bands``: ``_n``, ``_lo``, ``_hi`` of a group.

    They can ride along in a caller's own aggregation, which saves a pass.
    """
    step = MARGIN / accuracy
    ends = F.percentile_approx(value, [max(0.0, p - step), min(1.0, p + step)], accuracy)
    return [F.count(value).alias("_n"), F.get(ends, F.lit(0)).alias("_lo"), F.get(ends, F.lit(1)).alias("_hi")]


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where NULL equals NULL; key columns come from ``left``."""
    own = {k: f"_right_{i}" for i, k in enumerate(keys)}
    renamed = right.withColumnsRenamed(own)
    on = F.lit(True)
    for k, r in own.items():
        on = on & left[k].eqNullSafe(renamed[r])
    return left.join(renamed, on, how).drop(*own.values())


def _with_bands(rows: DataFrame, bands: DataFrame, keys: list[str], limit: int) -> DataFrame:
    """Each row with its group's band.

    Bands are one row per group: broadcast if their counted number is within
    ``limit``; beyond it both sides are shuffled, a group's rows in ``SALTS``
    parts, so that a hot group is not one task's.
    """
    if bands.count() <= limit:
        return join_null_safe(rows, F.broadcast(bands), keys)
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("_v"), F.lit(SALTS)).cast("int"))
    copies = bands.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return join_null_safe(salted, copies, [*keys, "_salt"]).drop("_salt")


def _counted(rows: DataFrame, bands: DataFrame, keys: list[str], limit: int) -> DataFrame:
    """``keys, _v, _c``: rows of each value inside the band, and of all values below it as one row (``_v`` NULL)."""
    v = F.col("_v")
    inside = _with_bands(rows, bands.select(*keys, "_lo", "_hi"), keys, limit)
    inside = inside.where(F.col("_hi").isNull() | (v <= F.col("_hi")))
    # NULL ends: all values.
    value = F.when(F.col("_lo").isNull() | (v >= F.col("_lo")), v).alias("_v")
    return inside.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c")).checkpoint()


def _told(counts: DataFrame, bands: DataFrame, keys: list[str]) -> DataFrame:
    """Each group's band with the number of its counted values, and whether the wanted rank lies outside the band."""
    sums = counts.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_values"),
        F.sum("_c").alias("_upto"),
        F.sum(F.when(F.col("_v").isNull(), F.col("_c")).otherwise(0)).alias("_below"),
    )
    none = F.coalesce("_upto", F.lit(0)) < F.col("_r")
    return join_null_safe(bands, sums, keys, "left").withColumn("_missed", none | (F.coalesce("_below", F.lit(0)) >= F.col("_r")))


def _at_rank(counts: DataFrame, bands: DataFrame, keys: list[str], one_window: bool) -> DataFrame:
    """``keys, _v``: the value at rank ``_r`` of each group's counted values."""
    if one_window:
        so_far = Window.partitionBy(*keys).orderBy(F.col("_v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
        running = counts.withColumn("_at", F.sum("_c").over(so_far))
    else:
        ranged = counts.repartitionByRange(*keys, "_v").withColumn("_part", F.spark_partition_id()).checkpoint()
        sums = ranged.groupBy(*keys, "_part").agg(F.sum("_c").alias("_s"))
        earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        offsets = sums.select(*keys, "_part", F.coalesce(F.sum("_s").over(earlier), F.lit(0)).alias("_o"))
        so_far = Window.partitionBy(*keys, "_part").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
        running = join_null_safe(ranged, offsets, [*keys, "_part"]).withColumn("_at", F.col("_o") + F.sum("_c").over(so_far))
    reached = join_null_safe(running, bands.select(*keys, "_r"), keys).where(F.col("_at") >= F.col("_r"))
    return reached.groupBy(*keys).agg(F.min(F.struct("_at", "_v")).alias("_f")).select(*keys, F.col("_f._v").alias("_v"))


def exact_percentile(
    df: DataFrame,
    keys: list[str],
    value: str,
    p: float,
    alias: str,
    accuracy: int = 10_000,
    broadcast_rows: int = BROADCAST_ROWS,
    bands: DataFrame | None = None,
    window_values: int = WINDOW_VALUES,
) -> DataFrame:
    """One row per group holding a non-NULL value: ``keys`` + ``alias``.

    Equals SQL ``percentile_disc(p) WITHIN GROUP (ORDER BY value)``: the
    smallest value whose cumulative share reaches ``p``. NULLs are ignored.

    ``bands`` (``keys`` and the columns of ``band``, materialised, e.g.
    checkpointed) saves the pass over the input that finds them here.
    """
    ensure_checkpoint_dir(df.sparkSession)
    rows = df.select(*keys, F.col(value).alias("_v")).where(F.col("_v").isNotNull())
    if bands is None:
        bands = rows.groupBy(*keys).agg(*band("_v", p, accuracy)).checkpoint()
    bands = bands.where(F.col("_n") > 0).select(*keys, "_lo", "_hi", rank_target(p, F.col("_n")).alias("_r"))
    counts = _counted(rows, bands, keys, broadcast_rows)
    facts = F.max("_values").alias("most"), F.count(F.when(F.col("_missed"), 1)).alias("missed")
    told = _told(counts, bands, keys)
    most, missed = told.agg(*facts).first()
    if missed:
        open_end = F.lit(None).cast(rows.schema["_v"].dataType)
        wide = told.where("_missed").select(*bands.columns).withColumns({"_lo": open_end, "_hi": open_end}).checkpoint()
        again = _counted(rows, wide, keys, broadcast_rows)
        held = join_null_safe(counts, told.select(*keys, "_missed"), keys).where(~F.col("_missed")).drop("_missed")
        counts = held.unionByName(again)
        most = max(most or 0, again.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0)
    found = _at_rank(counts, bands, keys, (most or 0) <= window_values)
    return found.where(F.col("_v").isNotNull()).select(*keys, F.col("_v").alias(alias))
