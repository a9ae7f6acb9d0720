"""Approximate nearest neighbours with an inverted multi-index.

A vector is cut into two halves; each half has its own codebook of ``k``
centroids (k-means on a bounded sample), and a vector lies in the cell of its
two nearest centroids. A query visits the ``k * k`` cells by the sum of its two
half distances, taken from a heap, until the visited cells hold a share of all
vectors; the entries of those cells are reranked by the exact distance.

The share is fitted, not guessed: on the sample, the smallest share whose
cells hold ``target_recall`` of the true neighbours of some sampled queries.
Neighbours only get closer as vectors are added, so it is a cautious share for
the whole table.

Work layout: vectors equal in every component are one entry that carries its
``top + 1`` smallest ids (no answer needs more), so a vector that a third of
the rows share is one entry. Entries lie in blocks of about ``BLOCK`` by their
first centroid, queries in packs of about ``PACK`` by the first centroid they
visit (with the list of second ones). A pack goes to every block of its
centroid: both are joined on centroid and block number, so a key is one block
and a full cell is many keys. The codebooks grow with the square root of the
number of entries (``size_of_codebooks``), and the sample they are fitted on
with them, up to ``MOST_SAMPLE`` vectors.

Defined results: vectors that are NULL, empty, zero, hold NULL or non-finite
components, or differ in length from the most frequent length (ties: the
longer) take no part, neither do rows without id. Rows with one id count as
one query and never as its own neighbour. Ties go to the smaller id. With no
usable vectors the result is empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import checkpointed, col, kept, map_arrow

BLOCK, PACK = 512, 256
LEAST_K, MOST_K = 32, 512  # centroids of a half; k * k cells are counted on the driver (2 MB at most)
MOST_SAMPLE = 40_000


def size_of_codebooks(n: int) -> int:
    """Centroids per half for ``n`` entries: a cell holds about 32 on average until MOST_K is reached."""
    return max(LEAST_K, min(MOST_K, round((n / 32) ** 0.5)))


def half_distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of ``x`` to the centroids."""
    d = (x * x).sum(1)[:, None] - 2 * x @ centroids.T + (centroids * centroids).sum(1)
    return np.maximum(d, 0)


def k_means(x: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    rng = np.random.default_rng(seed)
    k = min(k, len(x))
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = half_distances(x, c).argmin(1)
        n = np.bincount(near, minlength=k)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c[n > 0] = total[n > 0] / n[n > 0][:, None]
        c[n == 0] = x[rng.integers(len(x), size=int((n == 0).sum()))]
    return c


@dataclass(frozen=True)
class MultiIndex:
    first: np.ndarray
    second: np.ndarray
    share: float = 1.0

    @property
    def cut(self) -> int:
        return self.first.shape[1]

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return half_distances(x[:, : self.cut], self.first).argmin(1), half_distances(
            x[:, self.cut :], self.second
        ).argmin(1)

    def visit(self, q: np.ndarray, counts: np.ndarray, wanted: int) -> dict[int, list[int]]:
        """First centroid -> second centroids of the cells that ``q`` visits to see ``wanted`` entries."""
        d1 = half_distances(q[None, : self.cut], self.first)[0]
        d2 = half_distances(q[None, self.cut :], self.second)[0]
        o1, o2 = d1.argsort(kind="stable"), d2.argsort(kind="stable")
        s1, s2 = d1[o1].tolist(), d2[o2].tolist()
        # Pairs of ranks by summed distance: (a, b) opens (a, b + 1), and (a + 1, 0) if b is 0.
        heap, seen, found = [(s1[0] + s2[0], 0, 0)], 0, {}
        while heap and seen < wanted:
            _, a, b = heappop(heap)
            i, j = int(o1[a]), int(o2[b])
            if counts[i, j]:
                found.setdefault(i, []).append(j)
                seen += int(counts[i, j])
            if b + 1 < len(s2):
                heappush(heap, (s1[a] + s2[b + 1], a, b + 1))
            if b == 0 and a + 1 < len(s1):
                heappush(heap, (s1[a + 1] + s2[0], a + 1, 0))
        return found


def fit(sample: np.ndarray, k: int, top: int, target_recall: float, tries: int = 100, seed: int = 7) -> MultiIndex:
    """Codebooks and visiting share from the sampled vectors."""
    cut = sample.shape[1] // 2 or 1
    index = MultiIndex(k_means(sample[:, :cut], k, seed), k_means(sample[:, cut:], k, seed + 1))
    i, j = index.cells(sample)
    rng = np.random.default_rng(seed + 2)
    needed = []
    n = len(sample)
    for q in rng.choice(n, min(tries, n), replace=False):
        d = ((sample - sample[q]) ** 2).sum(1)
        d[q] = np.inf
        near = d.argsort(kind="stable")[: min(top, n - 1)]
        d1 = half_distances(sample[q][None, :cut], index.first)[0]
        d2 = half_distances(sample[q][None, cut:], index.second)[0]
        cost = np.sort(d1[i] + d2[j])
        # Share of entries whose cell comes no later than the neighbour's cell.
        needed += np.searchsorted(cost, d1[i[near]] + d2[j[near]], side="right").tolist()
    share = float(np.quantile(needed, target_recall, method="higher")) / n if needed else 1.0
    return MultiIndex(index.first, index.second, min(1.0, share))


def usable_vectors(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``id, vec`` (doubles) of the vectors that take part."""
    v = vectors.select(col(key).cast("long").alias("id"), col(vector).cast("array<double>").alias("vec"))
    good = (
        F.col("id").isNotNull()
        & F.col("vec").isNotNull()
        & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vec", lambda x: x != 0)
    )
    v = v.where(F.coalesce(good, F.lit(False)))
    size = v.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return v.where(F.size("vec") == (size.d if size else -1))


def matrix(lists: pa.Array) -> np.ndarray:
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), -1) if len(lists) else np.zeros((0, 0))


def distinct_entries(vectors: DataFrame, top: int) -> DataFrame:
    """One row per distinct vector: ``vec`` and its ``top + 1`` smallest ids (pre-aggregated in each batch)."""
    most = top + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b.column(1)) + 0.0  # -0.0 equals 0.0
            if not len(x):
                continue
            groups: dict[bytes, list[int]] = {}
            for raw, i in zip(map(bytes, np.ascontiguousarray(x)), b.column(0).to_pylist()):
                groups.setdefault(raw, []).append(i)
            vec = np.frombuffer(b"".join(groups), dtype=np.float64).reshape(len(groups), -1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(vec), type=pa.list_(pa.float64())),
                    pa.array([sorted(g)[:most] for g in groups.values()], type=pa.list_(pa.int64())),
                ],
                names=["vec", "ids"],
            )

    local = map_arrow(vectors.select("id", "vec"), run, "vec array<double>, ids array<long>")
    ids = F.slice(F.sort_array(F.flatten(F.collect_list("ids"))), 1, most)
    return local.groupBy("vec").agg(ids.alias("ids")).select(F.col("ids")[0].alias("vid"), "vec", "ids")


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    top: int = 10,
    k: int | None = None,
    sample: int | None = None,
    target_recall: float = 0.98,
) -> DataFrame:
    """The ``top`` nearest rows of ``vectors`` found for each row of ``queries``, itself excluded.

    Columns ``query_id, rank, vec_id, score`` (Euclidean distance in double
    precision). ``k`` (default: by the number of entries) is the size of each
    half's codebook, ``sample`` (default: 10,000 or 64 a centroid, MOST_SAMPLE
    at most) bounds the rows that both are fitted on; every row is indexed.
    """
    spark = vectors.sparkSession
    usable = usable_vectors(vectors, key, vector)
    entries = kept(distinct_entries(usable, top))
    n = entries.count()
    wanted_ids = usable_vectors(queries, key, vector).distinct()
    result = "query_id long, rank int, vec_id long, score double"
    if not n:
        return spark.createDataFrame([], result)

    k = k or size_of_codebooks(n)
    sample = sample or min(MOST_SAMPLE, max(10_000, 64 * k))
    part = min(1.0, 1.1 * sample / n)
    drawn = entries.where(F.pmod(F.xxhash64("vid"), F.lit(1_000_000)) < int(part * 1_000_000))
    rows = drawn.select("vec").limit(sample).collect() or entries.select("vec").limit(sample).collect()
    index = fit(np.array([r.vec for r in rows]), k, top, target_recall)
    k1, k2 = len(index.first), len(index.second)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                i, j = index.cells(matrix(b.column(1)))
                columns = [*b.columns, pa.array(i, pa.int32()), pa.array(j, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, names=["vid", "vec", "ids", "i", "j"])

    placed = kept(map_arrow(entries, assign, "vid long, vec array<double>, ids array<long>, i int, j int"))
    counts = np.zeros((k1, k2), dtype=np.int64)  # at most k * k rows
    for r in placed.groupBy("i", "j").count().collect():
        counts[r.i, r.j] = r["count"]
    goal = max(top + 1, int(np.ceil(index.share * n)))

    asked = checkpointed(wanted_ids.groupBy("vec").agg(F.min("id").alias("qid")))
    n_asked = asked.count()

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b.column(0))
            out: list[list] = [[], [], [], []]
            for q, qid in zip(x, b.column(1).to_pylist()):
                for i, js in index.visit(q, counts, goal).items():
                    for c, v in zip(out, (i, qid, q, js)):
                        c.append(v)
            kinds = (pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(out, kinds)], names=["i", "qid", "vec", "js"]
            )

    def packed(df: DataFrame, by: str, pieces, names: list[str], out: str) -> DataFrame:
        number = F.pmod(F.xxhash64(by), pieces).alias("piece")
        return df.select("i", number, F.struct(*names).alias("s")).groupBy("i", "piece").agg(F.collect_list("s").alias(out))

    # Blocks of each first centroid, known from the counted cells.
    n_blocks = [int(max(1, -(-int(c) // BLOCK))) for c in counts.sum(1)]
    pieces = F.element_at(F.array(*[F.lit(c) for c in n_blocks]), F.col("i") + 1)
    blocks = packed(placed, "vid", pieces, ["j", "vec", "ids"], "entries").withColumnRenamed("piece", "block")
    probes = map_arrow(asked, probe, "i int, qid long, vec array<double>, js array<int>")
    packs = packed(probes, "qid", F.lit(max(1, -(-n_asked // PACK))), ["qid", "vec", "js"], "asked")
    packs = packs.withColumn("block", F.explode(F.sequence(F.lit(0), (pieces - 1).cast("int"))))

    def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[], [], []]
            for r in range(b.num_rows):
                ej, ev, eids = b.column(0).slice(r, 1).flatten().flatten()
                qid, qv, qjs = b.column(1).slice(r, 1).flatten().flatten()
                ej, ev, eids, qv = ej.to_numpy(), matrix(ev), eids.to_pylist(), matrix(qv)
                told = np.zeros(k2, dtype=bool)
                for q, x, js in zip(qid.to_pylist(), qv, qjs.to_pylist()):
                    told[:] = False
                    told[js] = True
                    at = np.flatnonzero(told[ej])
                    if not len(at):
                        continue
                    d = np.sqrt(((ev[at] - x) ** 2).sum(1))
                    if len(at) > top + 1:
                        # All that may be among the first top + 1, ties included.
                        edge = np.partition(d, top)[top]
                        at, d = at[d <= edge], d[d <= edge]
                    best = sorted(
                        (x, i) for x, e in zip(d.tolist(), at.tolist()) for i in eids[e]
                    )[: top + 1]
                    out[0].append(q)
                    out[1].append([x for x, _ in best])
                    out[2].append([i for _, i in best])
            kinds = (pa.int64(), pa.list_(pa.float64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(out, kinds)], names=["qid", "d", "ids"]
            )

    met = blocks.join(packs.drop("piece"), ["i", "block"]).select("entries", "asked")
    partial = map_arrow(met, rerank, "qid long, d array<double>, ids array<long>")
    near = F.flatten(F.collect_list(F.arrays_zip("d", "ids")))
    found = partial.groupBy("qid").agg(F.slice(F.array_sort(near), 1, top + 1).alias("near"))
    answers = wanted_ids.join(asked, "vec").select(F.col("id").alias("query_id"), "qid").join(found, "qid")
    own = F.slice(F.filter("near", lambda x: x["ids"] != F.col("query_id")), 1, top)
    return answers.select("query_id", F.posexplode(own).alias("at", "x")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.ids").alias("vec_id"), F.col("x.d").alias("score")
    )
