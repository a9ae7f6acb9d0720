"""Near duplicates by SuperMinHash signatures, banding, verification and grouping.

1. A text's set holds the hashes of its distinct word shingles. Texts with
   equal sets form a class; from here on a class is one node, so a group of
   thousands of copies is one row.
2. SuperMinHash: each element walks a permutation of the ``m`` slots of its
   own; at step ``j`` it offers ``j + r`` (``r`` uniform in [0, 1)) to its
   ``j``-th slot. Each slot keeps its minimum. Values of step ``j`` lie in
   ``[j, j + 1)``, so a text stops as soon as all its slots are below the next
   step. Ranks of one element differ between slots, which lowers the variance
   against independent hashes.
3. Banding: ``rows`` slots make a band key; classes that share a key are
   candidates. Each bucket has one pivot (its smallest node) and every member
   is verified against it on the full sets: linear in the bucket's size.
4. Links make components (minimum label, neighbours and pointer jumping, each
   round checkpointed).
5. Pivots of one component make a family. Members of a family that are still
   in different components may be linked with each other. Their differences
   to a reference set ``R`` tell: ``|x ^ y|`` equals ``|Dx ^ Dy|`` for ``Dx = x ^ R``.
   ``R`` is the consensus of the family (what most members hold), so differences
   are small. Members whose differences are together within what a link allows
   are linked for certain, all of them with the member of least slack; any
   other pair needs common differences, and a prefix filter, rarest elements
   first, meets only pairs that share one of their rarest ones: near copies of
   one text with edits of their own share none, however many they are. Such
   pairs are decided exactly by their differences, which come from the full sets;
   new links join the components. (Form letters that are too far apart for a
   link but share some of few field values do share rare elements: there the
   filter lets a fixed share of the family's pairs through, as numbers, not texts.)

``bands = 30, rows = 5`` misses a pair of similarity 0.8 with probability
(1 - 0.8**5)**30 = 7e-6, and closer pairs far less often.

Defined results: texts without words have no shingles and are linked with
nothing; a text with fewer words than a shingle is one shingle; NULL reads as
empty; rows that repeat an id are rows of their own (all with the results of
their text), rows without id link as any other; a component's id is the
smallest id of its rows, NULL if there is none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import checkpointed, chunks, col, in_buckets, kept, map_arrow, map_texts, unused

U = np.uint64
SALTS = 32


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (xor-shift-multiply) of each element."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def shingle_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; words by ASCII white space, A-Z lower-cased."""
    words = [(t or "").encode().lower().split() for t in texts]
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    flat = np.empty(int(sizes.sum()), dtype=object)
    flat[:] = [w for x in words for w in x]
    if not len(flat):
        return [np.zeros(0, U) for _ in texts]
    hashed = pd.util.hash_array(flat, categorize=False)
    n = len(hashed)  # a shingle is folded word by word
    whole = hashed.copy()
    for k in range(1, width):
        whole[: n - k] = mixed(whole[: n - k] * U(0x9E3779B97F4A7C15) + hashed[k:])
    starts = np.concatenate([[0], np.cumsum(sizes)])
    sets = []
    for s, e in zip(starts[:-1].tolist(), starts[1:].tolist()):
        if e - s >= width:
            sets.append(np.unique(whole[s : e - width + 1]))
        elif e > s:  # the whole sequence as one shingle, apart from longer ones
            one = np.array([e - s], dtype=U)
            for h in hashed[s:e]:
                one = mixed(one * U(0x9E3779B97F4A7C15) + h)
            sets.append(one)
        else:
            sets.append(np.zeros(0, U))
    return sets


def super_minhash(sets: list[np.ndarray], m: int) -> np.ndarray:
    """SuperMinHash signatures (texts x ``m``) of non-empty sets; all texts advance step by step together."""
    if m > 255:
        raise ValueError("at most 255 slots")
    n = len(sets)
    sig = np.full((n, m), np.inf)
    if not n:
        return sig
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    item = np.concatenate(sets)
    order = None  # permutation state, (elements x m), from step 1 on
    with np.errstate(over="ignore"):
        for j in range(m):
            x = mixed(item + U(j + 1) * U(0x9E3779B97F4A7C15))
            value = (x >> U(11)).astype(np.float64) * 2.0**-53 + j
            k = j + (mixed(x) % U(m - j)).astype(np.int64)
            if order is None:
                slot = k
            else:
                at = np.arange(len(k))
                slot = order[at, k]
                order[at, k] = order[:, j]
            np.minimum.at(sig.reshape(-1), row * m + slot, value)
            open_rows = sig.max(1) > j + 1
            use = open_rows[row]
            if not use.any():
                break
            if order is None:
                first = k[use]
                order = np.tile(np.arange(m, dtype=np.uint8), (int(use.sum()), 1))
                order[np.arange(len(first)), first] = 0  # slot 0 took the place of the first choice
            elif not use.all():
                order = order[use]
            row, item = row[use], item[use]
    return sig


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    bits = np.ascontiguousarray(sig).view(U).reshape(len(sig), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=U), bits.shape[:2]).copy()
    with np.errstate(over="ignore"):
        for r in range(rows):
            key = mixed(key * U(0x9E3779B97F4A7C15) + bits[:, :, r])
    return key.view(np.int64)


ELEMENTS = 40_000  # set elements that are signed together: bounds the permutation state (ELEMENTS x m bytes)


def signed(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """Band keys of all texts (a text of more elements than ELEMENTS is signed on its own)."""
    keys = np.zeros((len(sets), bands), dtype=np.int64)
    group: list[int] = []
    size = 0
    for i, s in [*enumerate(sets), (-1, np.zeros(0))]:
        if group and (i < 0 or size + len(s) > ELEMENTS):
            keys[group] = band_keys(super_minhash([sets[g] for g in group], bands * rows), bands, rows)
            group, size = [], 0
        if len(s):
            group.append(i)
            size += len(s)
    return keys


def signatures(docs: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    """``doc_id, at, n_shingles, node, keys`` per row; ``node`` names the set (NULL: no words), ``at`` the row."""

    def work(ids: list, texts: list, at: list) -> list:
        sets = shingle_sets(texts, width)
        node = [
            int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "big", signed=True) if len(s) else None
            for s in sets
        ]
        return [ids, at, [len(s) for s in sets], node, list(signed(sets, bands, rows))]

    fields = "doc_id long, at long, n_shingles long, node long, keys array<long>"
    return map_texts(docs.select("doc_id", "text", "at"), work, fields)


def named(key: str, text: str) -> Column:
    """A hash of id and text that finds a row again, also one without id; equal rows have one name."""
    return F.xxhash64(col(key).cast("long"), col(text).cast("string"))


def verify(pairs: DataFrame, texts: DataFrame, width: int, differences: bool = False) -> DataFrame:
    """Sizes of both sets and of their symmetric difference for each pair ``a, b``, on the full sets.

    Columns ``a, b, na, nb, apart``; with ``differences`` also the differing shingles.
    """
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("a_text"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("b_text"))
    full = pairs.join(left, "a").join(right, "b").select("a", "b", "a_text", "b_text")
    fields = "a long, b long, na long, nb long, apart long" + ", difference array<long>" * differences

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, pivot = None, None
        for a, b, a_text, b_text in chunks(batches, text=2):
            out: list[list] = [[] for _ in range(4)]
            for node, x, t in zip(b, shingle_sets(a_text, width), b_text):
                if node != last:  # members of one pivot come together
                    last, pivot = node, shingle_sets([t], width)[0]
                d = np.setxor1d(x, pivot, assume_unique=True)
                for c, v in zip(out, (len(x), len(pivot), len(d), d.view(np.int64))):
                    c.append(v)
            columns = [pa.array(c, pa.int64()) for c in (a, b, *out[:3])]
            if differences:
                columns.append(pa.array(out[3], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in fields.split(", ")])

    return map_arrow(full, run, fields)


def with_family(members: DataFrame, facts: DataFrame, how: str = "inner") -> DataFrame:
    """``members`` with the ``facts`` (one row) of their ``family``; a hot family's members meet it in SALTS parts."""
    salted = members.withColumn("part", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
    copies = facts.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    # Merged, not broadcast: the copies compress so well that their size is misjudged.
    return salted.join(copies.hint("merge"), ["family", "part"], how).drop("part")


def linked(percent: int) -> Column:
    """``100 * |A & B| >= percent * |A | B|`` from ``na``, ``nb`` and ``apart``."""
    total = F.col("na") + F.col("nb")
    return 100 * (total - F.col("apart")) >= percent * (total + F.col("apart"))


def to_consensus(members: DataFrame) -> DataFrame:
    """``family, node, n, difference`` with differences to the family's consensus, and their number ``apart``.

    Elements that most members differ in are turned round: there the
    reference that the differences were taken from is the odd one out.
    """
    size = members.groupBy("family").agg(F.count(F.lit(1)).alias("size"))
    often = members.select("family", F.explode("difference").alias("e")).groupBy("family", "e").agg(F.count(F.lit(1)).alias("f"))
    # A hot family's elements meet its size in parts; what is left is about as much as one difference.
    part = F.pmod(F.xxhash64("e"), F.lit(SALTS)).cast("int")
    sizes = size.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    most = often.withColumn("part", part).join(sizes, ["family", "part"]).where("2 * f > size")
    turned = most.groupBy("family").agg(F.collect_list("e").alias("turned"))
    both = with_family(members, turned, "left")
    difference = F.when(F.col("turned").isNull(), F.col("difference")).otherwise(
        F.concat(F.array_except("difference", "turned"), F.array_except("turned", "difference"))
    )
    return both.select("family", "node", "n", difference.alias("difference")).withColumn("apart", F.size("difference").cast("long"))


def slack(percent: int) -> Column:
    """Two members with slacks that add up to 0 or less are linked, as the triangle inequality has it."""
    return (100 + percent) * F.col("apart") - (100 - percent) * F.col("n")


def unmet_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Pairs ``family, a, b`` of one family's members in different components that may be linked.

    ``members``: ``family, node, root, n, apart, difference`` and of the family ``center_root``
    (component of the member of least slack). A link allows a difference of at
    most ``t = (100 - percent) / (100 + percent) * (n + n')``, and sizes differ at most by the
    factor ``100 / percent``, so the overlap of the differences of a pair with
    ``apart <= apart'`` is at least ``(apart + apart' - t) / 2``. Seen from the smaller that is
    ``apart - t / 2``, or, inside the center's component, with the least ``apart'`` outside
    it; seen from the larger, ``apart' - t``. It is at least 1, as other pairs are linked
    for certain. The first ``apart - overlap + 1`` elements of either, in one order,
    then share an element.
    """
    far, near = 100 - percent, 100 + percent
    n, a = F.col("n"), F.col("apart")
    inside = F.col("root") == F.col("center_root")
    family = members.groupBy("family").agg(
        F.max("n").alias("most_n"), F.min(F.when(~inside, a)).alias("least_outside"),
        F.min("root").alias("lo"), F.max("root").alias("hi"),
    )
    members = with_family(members, family.where("lo != hi"))
    t = F.floor(far * (n + F.least(F.col("most_n"), F.floor(n * 100 / percent))) / near)
    least_small = F.greatest(
        F.lit(1), F.ceil(a - t / 2), F.when(inside, F.ceil((a + F.col("least_outside") - t) / 2)).otherwise(F.lit(1))
    )
    least_large = F.greatest(F.lit(1), a - t)
    sized = members.select(
        "family", "node", "root", "n", "apart", "difference",
        (a - least_small + 1).alias("small"), (a - least_large + 1).alias("large"),
    )
    sized = kept(sized)
    spread = sized.select("family", "node", F.explode("difference").alias("e"))
    shared = spread.groupBy("family", "e").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    # Elements of one member only cannot meet; they come first in the order and take up prefix places.
    ranked = kept(
        spread.join(shared, ["family", "e"])
        .groupBy("family", "node")
        .agg(F.array_sort(F.collect_list(F.struct("f", "e"))).alias("es"))
        .join(sized.drop("difference"), ["family", "node"])
        .withColumn("alone", F.col("apart") - F.size("es"))
    )

    def prefix(length: str) -> DataFrame:
        room = F.greatest(F.lit(0), F.col(length) - F.col("alone")).cast("int")
        return ranked.select("family", "node", "root", "n", "apart", F.explode(F.slice("es", F.lit(1), room)["e"]).alias("e"))

    x, y = prefix("small").alias("x"), prefix("large").alias("y")
    order = (F.col("x.apart") < F.col("y.apart")) | (
        (F.col("x.apart") == F.col("y.apart")) & (F.col("x.node") < F.col("y.node"))
    )
    met = x.join(
        y,
        (F.col("x.family") == F.col("y.family"))
        & (F.col("x.e") == F.col("y.e"))
        & (F.col("x.root") != F.col("y.root"))
        & order
        & (near * (F.col("y.apart") - F.col("x.apart")) <= far * (F.col("x.n") + F.col("y.n"))),
    )
    return met.select(F.col("x.family").alias("family"), F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


def told_apart(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """``a, b, na, nb, apart`` of pairs of one family, exactly, from the members' differences to their consensus.

    ``x ^ y`` equals ``Dx ^ Dy``: no text is fetched for a pair.
    """
    side = lambda c: members.select(
        "family", F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("difference").alias(f"d{c}")
    )
    both = pairs.join(side("a"), ["family", "a"]).join(side("b"), ["family", "b"])
    common = F.size(F.array_intersect("da", "db"))
    return both.select("a", "b", "na", "nb", (F.size("da") + F.size("db") - 2 * common).cast("long").alias("apart"))


def further_links(pairs: DataFrame, found: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame | None:
    """Links between members of one family that no pivot has shown: ``a, b``."""
    roots = found.select(F.col("node").alias("b"), F.col("root").alias("family"))
    of = pairs.join(roots, "b", "left").withColumn("family", F.coalesce("family", "b"))
    family = of.select("family", F.col("a").alias("node")).union(of.select("family", "b")).distinct()
    family = family.join(found, "node", "left").select("family", "node", F.coalesce("root", "node").alias("root"))
    several = family.groupBy("family").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi")
    family = checkpointed(with_family(family, several.select("family")))
    if family.isEmpty():
        return None

    apart = family.where("node != family").select(F.col("node").alias("a"), F.col("family").alias("b"))
    told = kept(verify(apart, texts, width, differences=True))
    references = told.groupBy("b").agg(F.first("nb").alias("n"))
    members = told.select(F.col("b").alias("family"), F.col("a").alias("node"), F.col("na").alias("n"), "difference").union(
        references.select("b", "b", "n", F.array().cast("array<bigint>"))
    )
    members = to_consensus(members).withColumn("slack", slack(percent))
    members = kept(members)
    centers = members.groupBy("family").agg(F.min(F.struct("slack", "node")).alias("c"))
    centers = centers.select("family", F.col("c.node").alias("center"), F.col("c.slack").alias("least"))
    sure = with_family(members, centers).where((F.col("slack") + F.col("least") <= 0) & (F.col("node") != F.col("center")))
    sure = checkpointed(sure.select(F.col("node").alias("a"), F.col("center").alias("b")))

    joined = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).where("a != b").union(sure))
    rooted = joined.select("node", "root")
    open_ = members.join(rooted, "node", "left").withColumn("root", F.coalesce("root", "node"))
    center_roots = centers.join(rooted.withColumnRenamed("node", "center"), "center", "left")
    center_roots = center_roots.select("family", F.coalesce("root", "center").alias("center_root"))
    more = checkpointed(unmet_pairs(with_family(open_, center_roots), percent))
    met = told_apart(more, members).where(linked(percent)).select("a", "b")
    return checkpointed(sure.union(met))


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of all nodes in ``links`` (``a, b``): root is the smallest node of the component."""
    both = links.select("a", "b").union(links.select("b", "a")).distinct()
    edges = checkpointed(both)
    labels = checkpointed(
        edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root"))
    )
    while True:
        near = (
            edges.join(labels, edges.b == labels.node)
            .groupBy("a")
            .agg(F.min("root").alias("m"))
            .withColumnRenamed("a", "node")
        )
        told = labels.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "m").alias("root"))
        # One jump along the old labels: the root's root.
        jump = labels.select(F.col("node").alias("root"), F.col("root").alias("further"))
        new = checkpointed(
            told.join(jump, "root").select("node", "old", F.least("root", "further").alias("root"))
        )
        labels = new.select("node", "root")
        if new.where("old != root").isEmpty():
            return labels


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = 5,
    percent: int = 80,
    bands: int = 30,
    rows: int = 5,
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    Rows are linked when ``100 * |A & B| >= percent * |A | B|`` on their
    shingle sets; ``kept`` marks the smallest id of a component.
    """
    return grouped(docs, key, text, width, percent, bands, rows).drop("at", "root")


def grouped(docs: DataFrame, key: str, text: str, width: int, percent: int, bands: int, rows: int) -> DataFrame:
    """``near_duplicates`` with the row's name ``at`` and the component's name ``root`` (NULL: no words)."""
    docs = docs.select(
        col(key).cast("long").alias("doc_id"), col(text).cast("string").alias("text"), named(key, text).alias("at")
    )
    signs = kept(signatures(docs, width, bands, rows))
    some = signs.where("node is not null")
    # One row per distinct set; the row with the smallest id lends its text.
    classes = some.groupBy("node").agg(
        F.min("doc_id").alias("least_id"), F.first("keys").alias("keys")
    )
    members = checkpointed(classes.select("node", F.explode("keys").alias("bucket")))
    pivots = members.groupBy("bucket").agg(F.min("node").alias("pivot"), F.count(F.lit(1)).alias("c")).where("c > 1")
    shared = members.join(pivots.select("bucket", "pivot"), "bucket")
    pairs = shared.where(F.col("node") != F.col("pivot")).select(F.col("node").alias("a"), F.col("pivot").alias("b"))
    pairs = checkpointed(pairs.distinct())

    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    lenders = wanted.join(some.select("node", "at"), "node").groupBy("node").agg(F.min("at").alias("at"))
    texts = class_texts(docs, lenders, width)

    links = checkpointed(verify(pairs, texts, width).where(linked(percent)).select("a", "b"))
    found = components(links)
    more = further_links(pairs, found, texts, width, percent)
    if more is not None and not more.isEmpty():
        found = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).where("a != b").union(more))

    rooted = classes.select("node", "least_id").join(found, "node", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    told = rooted.join(least, "root").select("node", "root", "component_id")
    return (
        signs.select("doc_id", "at", "n_shingles", "node")
        .join(told, "node", "left")
        .select(
            "doc_id",
            "at",
            "root",
            "n_shingles",
            F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
    )


def class_texts(docs: DataFrame, lenders: DataFrame, width: int) -> DataFrame:
    """``node, text``: one text for each wanted class, written once.

    Rows are found by their name, so that one without id lends its text too; the set's own name makes sure.
    """

    def work(node: list, texts: list) -> list:
        names = [
            int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "big", signed=True)
            for s in shingle_sets(texts, width)
        ]
        use = [n == m for n, m in zip(node, names)]
        return [[n for n, u in zip(node, use) if u], [t for t, u in zip(texts, use) if u]]

    lenders = checkpointed(lenders)
    of = in_buckets(docs.select("at", "text"), lenders, "at").dropDuplicates(["at"]).join(lenders, "at").select("node", "text")
    return kept(map_texts(of, work, "node long, text string")).dropDuplicates(["node"])


def without_near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = 5,
    percent: int = 80,
    bands: int = 30,
    rows: int = 5,
) -> DataFrame:
    """``docs`` with one row of each group of near duplicates; columns stay.

    It is the row with the smallest id (rows without id come last; rows that
    repeat an id with other words: any one, the same in every run). Rows
    without words are linked with nothing and stay. Rows that repeat both id
    and text are one row afterwards.
    """
    told = kept(grouped(docs, key, text, width, percent, bands, rows).select("doc_id", "at", "root"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "at"))
    chosen = told.where("root is not null").groupBy("root").agg(first.alias("f")).select(F.col("f.at").alias("at"))
    # A group's rows that are not its chosen one go; what is left are single rows and repeated ones.
    left = told.where("root is null").select("at").union(chosen).distinct()
    times = told.groupBy("at").agg(F.count(F.lit(1)).alias("times")).join(left, "at", "left_semi")
    at, n = unused(docs, "_at"), unused(docs, "_times")
    held = docs.withColumn(at, named(key, text)).join(times.select(F.col("at").alias(at), F.col("times").alias(n)), at)
    names = [col(c) for c in docs.columns]
    single = held.where(F.col(n) == 1).select(*names)
    if times.where("times > 1").isEmpty():
        return single
    return single.unionByName(held.where(F.col(n) > 1).dropDuplicates([at]).select(*names))
