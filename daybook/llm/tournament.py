"""k-means over integer vectors, with exact arithmetic from start to end.

A vector's nearest centroid is found by a tournament of bisectors. For every
pair of centroids ``a < b`` the integer normal ``2 * (c_b - c_a)`` and the
threshold ``|c_b|^2 - |c_a|^2`` are computed once a round; ``b`` is strictly
nearer than ``a`` where ``normal . x > threshold``. The champion (first the
centroid 0) meets 1, 2, ... k - 1, one linear sign test each: zero favours the
smaller number, which is always the champion's. Only the winner's distance is
computed, exactly.

Work layout: the integer vectors are written once. A round is one pass in which
a task adds up the vectors of each cluster and hands over one row per cluster
(at most k rows a task, whatever a cluster's share of all vectors); Spark adds
these up per cluster, and the driver receives k rows: the next centroids.

Exactness: up to a size of the components (``small_enough``) every test fits 64
bits. A slice of vectors with larger ones is worked in Python's integers, up to
``LARGEST``; beyond it (a component of 2**52) the run ends with an error that
says so. Sums travel as 38-digit decimals. A distance or an inertia that does
not fit 64 bits is NULL.

Defined results: vectors that are NULL, have another number of components, or
hold a NULL or non-finite one take no part; a NULL or repeated id does. Start
centroids are the vectors with the smallest hashes of their ids, ties (repeated
ids) by the vector, a NULL id last. With fewer vectors than ``k`` there are as
many centroids as vectors. Without vectors the result is empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import col, kept, map_arrow

LARGEST = 1 << 60
ROWS = 2048  # vectors tested at once in a task
SUM = "decimal(38,0)"


def integers(vectors: DataFrame, key: str, vector: str, size: int, scale: int) -> DataFrame:
    """``id, hash, v``: ``floor(scale * x)`` of the components of the vectors that take part."""
    v = vectors.select(col(key).cast("long").alias("id"), col(vector).cast("array<double>").alias("vec"))
    good = (F.size("vec") == size) & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    fits = F.forall("vec", lambda x: F.abs(x) * scale < float(LARGEST))
    floors = F.transform("vec", lambda x: F.floor(x * scale))
    told = F.when(fits, floors).otherwise(F.raise_error(F.lit(f"a component times {scale} is 2**60 or more")))
    return v.where(F.coalesce(good, F.lit(False))).select("id", told.cast("array<long>").alias("v"))


def start(points: DataFrame, k: int, seed: str) -> list[list[int]]:
    """The vectors with the ``k`` smallest id hashes, in ascending order (a top-k, no sort of all)."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    rows = points.select(order.alias("h"), "v").orderBy(F.asc_nulls_last("h"), "v").limit(k).collect()
    return [list(r.v) for r in rows]


class Bisectors:
    """Normals and thresholds of all centroid pairs, in 64-bit or Python integers."""

    def __init__(self, centroids: list[list[int]], kind: type) -> None:
        self.kind = kind
        self.c = c = np.array(centroids, dtype=kind)
        self.normals = 2 * (c[None, :, :] - c[:, None, :])  # [a, b]
        squares = (c * c).sum(1)
        self.thresholds = squares[None, :] - squares[:, None]

    def nearest(self, x: np.ndarray) -> np.ndarray:
        champion = np.zeros(len(x), dtype=np.int64)
        for b in range(1, len(self.c)):
            beyond = (self.normals[champion, b] * x).sum(1) - self.thresholds[champion, b]
            champion[beyond > 0] = b
        return champion

    def distances(self, x: np.ndarray, champion: np.ndarray) -> np.ndarray:
        gap = x - self.c[champion]
        return (gap * gap).sum(1)


def small_enough(size: int) -> int:
    """Components up to this size keep ``normal . x - threshold`` within 64 bits: 5 * size * s * s < 2**63."""
    return isqrt((1 << 63) // (5 * max(size, 1))) - 1


class Tournament:
    """Assigns slices of vectors to their nearest centroids."""

    def __init__(self, centroids: list[list[int]]) -> None:
        self.centroids = centroids
        self.most = small_enough(len(centroids[0]))
        self.small = max((abs(x) for c in centroids for x in c), default=0) <= self.most
        self.made: dict[type, Bisectors] = {}

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The vectors in the integers they need, their clusters and squared distances."""
        kind = np.int64 if self.small and (not x.size or max(x.max(), -x.min()) <= self.most) else object
        if kind not in self.made:
            self.made[kind] = Bisectors(self.centroids, kind)
        x = x.astype(kind)
        champion = self.made[kind].nearest(x)
        return x, champion, self.made[kind].distances(x, champion)


def blocks(batches: Iterator[pa.RecordBatch], column: int, size: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            yield part, part.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def next_centroids(points: DataFrame, centroids: list[list[int]], size: int) -> list[list[int]]:
    """One round: every vector to its nearest centroid, then componentwise ``floor(sum / count)``."""
    names = [f"s{i}" for i in range(size)]
    wide = pa.decimal128(38, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        game = Tournament(centroids)
        counts = [0] * len(centroids)
        sums = np.zeros((len(centroids), size), dtype=object)
        for _, x in blocks(batches, 0, size):
            x, champion, _ = game.assign(x)
            for c in np.unique(champion).tolist():
                mine = x[champion == c]
                counts[c] += len(mine)
                sums[c] += mine.sum(0).astype(object)
        rows = [c for c, n in enumerate(counts) if n]
        columns = [pa.array(rows, pa.int32()), pa.array([counts[c] for c in rows], pa.int64())]
        columns += [pa.array([Decimal(sums[c, i]) for c in rows], wide) for i in range(size)]
        yield pa.RecordBatch.from_arrays(columns, names=["cluster", "n", *names])

    fields = ", ".join(["cluster int", "n long", *[f"{s} {SUM}" for s in names]])
    partial = map_arrow(points.select("v"), run, fields)
    added = partial.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(s).alias(s) for s in names])
    out = list(centroids)
    for r in added.collect():  # at most k rows
        out[r.cluster] = [int(r[s]) // r.n for s in names]
    return out


def cluster(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    size: int = 64,
    scale: int = 256,
    k: int = 40,
    rounds: int = 5,
    seed: str = "2",
) -> DataFrame:
    """Per vector that takes part: ``vec_id, cluster, distance, cluster_inertia, inertia, centroid, centroid_sha256``.

    ``distance`` is the squared distance to the final centroid (``centroid``,
    an array of integers, with the digest of its components joined by commas);
    the inertias add it up over the cluster and over all.
    """
    spark = vectors.sparkSession
    points = kept(integers(vectors, key, vector, size, scale))
    centroids = start(points, k, seed)
    facts_of = "cluster_inertia long, inertia long, centroid array<long>, centroid_sha256 string"
    if not centroids:
        return spark.createDataFrame([], f"vec_id long, cluster int, distance long, {facts_of}")
    for _ in range(rounds):
        centroids = next_centroids(points, centroids, size)

    wide = pa.decimal128(38, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        game = Tournament(centroids)
        for part, x in blocks(batches, 1, size):
            _, champion, distance = game.assign(x)
            exact = pa.array([Decimal(int(d)) for d in distance], wide)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(champion, pa.int32()), exact], names=["vec_id", "cluster", "d"]
            )

    told = kept(map_arrow(points, run, f"vec_id long, cluster int, d {SUM}"))
    sums = told.groupBy("cluster").agg(F.sum("d").alias("d")).collect()  # at most k rows
    total = sum(int(r.d) for r in sums)
    fits = lambda d: d if d < 1 << 63 else None
    digest = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    facts = [(r.cluster, fits(int(r.d)), fits(total), centroids[r.cluster], digest(centroids[r.cluster])) for r in sums]
    ends = spark.createDataFrame(facts, f"cluster int, {facts_of}")
    return told.join(F.broadcast(ends), "cluster").select(
        "vec_id",
        "cluster",
        F.expr("try_cast(d AS BIGINT)").alias("distance"),
        *ends.columns[1:],
    )
