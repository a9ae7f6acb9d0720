"""Benchmark decontamination with SimHash windows (DataFrame functions only).

A document leaks a benchmark item if some window of it, as many words long as
the item, has a weighted-shingle similarity (sum of minima over sum of maxima
of the shingle counts) of at least ``percent`` / 100.

1. Words are runs of letters and digits, lower-cased; shingles are ``width``
   words; an item of fewer words is one shingle of all its words.
2. A window that is similar enough holds all but a few of an item's shingles,
   so it must hold one of any ``m - ceil(percent * m / 100) + 1`` of them: the
   documents' shingles meet only these anchors of each item.
3. In documents that hold an anchor, the windows that can reach the similarity
   are those that hold enough of the item's shingles; sliding a window right
   up to its next shingle of the item loses none, so only windows that start
   at one (or end with the text) need to be looked at.
4. Each window gets a 64-bit SimHash of its shingles, looked up in the item's
   multi-index: ``BLOCKS`` blocks of the item's SimHash, each with all values
   within ``BLOCK_RADIUS`` bits. If two fingerprints differ in at most
   ``RADIUS`` <= BLOCKS * (BLOCK_RADIUS + 1) - 1 bits, some block differs in at
   most ``BLOCK_RADIUS``, so no fingerprint within the radius is missed.
   At similarity 0.8 the bits differ with probability acos(8/9) / pi = 0.15:
   9.7 of 64 on average, standard deviation 2.9; the radius lies 6 deviations
   above.
5. The exact similarity of the remaining windows decides.

Windows stay arrays inside a (document, item) row: nothing is exploded for
them. Anchors and items are broadcast only after their rows are counted
(``broadcast_rows``), else they are shuffled; the result is the same.

Defined results: NULL or empty texts and items without words leak nothing;
rows that repeat id and text give one result; equal items under one id are one;
of equally similar windows the earliest that starts at a shared shingle counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import checkpointed, col, in_buckets, kept

BLOCKS, BLOCK_BITS, BLOCK_RADIUS, RADIUS = 8, 8, 3, 28


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def shingles_of(words: str, width: Column) -> Column:
    """Hashes of the shingles of an array of words, in order; empty if there are too few words."""
    last = F.size(words) - width + 1
    return F.when(
        last >= 1, F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice(words, i, width)))
    ).otherwise(F.array().cast("array<bigint>"))


def simhash(shingles: Column) -> Column:
    """64 bits; a bit is set where more than half of the shingles' hashes have it set."""

    def bit(shift: Column) -> Column:
        ones = F.aggregate(
            shingles,
            F.lit(0).cast("long"),
            lambda n, h: n + F.call_function("shiftrightunsigned", h, shift).bitwiseAND(F.lit(1).cast("long")),
        )
        return F.call_function("shiftleft", (2 * ones > F.size(shingles)).cast("long"), shift)

    return F.aggregate(
        F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), lambda bits, b: bits.bitwiseOR(bit(b))
    )


def block(bits: Column, number: Column) -> Column:
    shifted = F.call_function("shiftrightunsigned", bits, (number * BLOCK_BITS).cast("int"))
    return shifted.bitwiseAND(F.lit((1 << BLOCK_BITS) - 1).cast("long")).cast("int")


def block_codes(bits: Column, radius: int) -> Column:
    """``block number * 2**BLOCK_BITS + value`` of every value within ``radius`` bits of each block."""
    size = 1 << BLOCK_BITS
    numbers = F.sequence(F.lit(0), F.lit(BLOCKS - 1))
    if not radius:
        return F.transform(numbers, lambda b: b * size + block(bits, b))
    values = F.sequence(F.lit(0), F.lit(size - 1))
    return F.flatten(
        F.transform(
            numbers,
            lambda b: F.transform(
                F.filter(values, lambda v: F.bit_count(v.bitwiseXOR(block(bits, b))) <= radius), lambda v: b * size + v
            ),
        )
    )


def indexed_items(items: DataFrame, key: str, text: str, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Per item its shingles with counts, SimHash and block index; and the anchors (``item, h``)."""
    words = items.select(col(key).cast("long").alias("item_id"), words_of(col(text).cast("string")).alias("words"))
    words = words.where(F.size("words") > 0).distinct()
    hashed = words.withColumn("width", F.least(F.size("words"), F.lit(width))).withColumn("item", F.xxhash64("item_id", "words"))
    hashed = hashed.withColumn("shingles", shingles_of("words", F.col("width")))
    hashed = hashed.withColumn("m", F.size("shingles")).withColumn("simhash", simhash(F.col("shingles")))
    known = hashed.select("item", "item_id", "width", "m", "shingles", "simhash")
    known = known.withColumn("index", block_codes(F.col("simhash"), BLOCK_RADIUS))
    known = known.withColumn("distinct", F.array_sort(F.array_distinct("shingles")))
    known = known.withColumn(
        "counts",
        F.transform("distinct", lambda h: F.size(F.filter("shingles", lambda x: x == h))),
    )
    known = checkpointed(known)
    # Distinct shingles in hash order until more of them are taken than may be missing.
    spare = F.col("m") - F.ceil(F.col("m") * percent / 100)
    before = lambda i: F.aggregate(F.slice("counts", F.lit(1), i), F.lit(0), lambda s, c: s + c)
    taken = F.filter("distinct", lambda h, i: before(i) <= spare)
    anchors = known.select("item", "width", F.explode(taken).alias("h"))
    return known, checkpointed(anchors)


def bounded(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast only below a counted number of rows."""
    return F.broadcast(df) if df.count() <= rows else df


def leaks(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    width: int = 5,
    percent: int = 80,
    broadcast_rows: int = 200_000,
) -> DataFrame:
    """``row, doc_id, item_id, similarity, window_start, distance`` of each document and item that it leaks.

    ``window_start`` (in words, from 0) and the fingerprints' ``distance``
    are those of the most similar window.
    """
    known, anchors = indexed_items(items, item_key, item_text, width, percent)
    rows = docs.select(col(key).cast("long").alias("doc_id"), col(text).cast("string").alias("text"))
    rows = rows.withColumn("row", F.xxhash64("doc_id", "text"))
    found = None
    for r in anchors.select("width").distinct().collect():  # at most `width` widths
        own = anchors.where(F.col("width") == r.width).select("item", "h")
        hashed = rows.select("row", words_of(F.col("text")).alias("words"))
        # explode_outer: an inferred filter on the array would hash every text a second time.
        hashed = hashed.select("row", F.explode_outer(shingles_of("words", F.lit(r.width))).alias("h"))
        met = hashed.join(bounded(own, broadcast_rows), "h").select("row", "item").distinct()
        found = met if found is None else found.unionByName(met)
    if found is None:
        found = rows.select("row", F.lit(None).cast("long").alias("item")).where("false")
    found = checkpointed(found)

    wide = in_buckets(rows, found, "row").dropDuplicates(["row"]).join(found, "row")
    wide = wide.join(bounded(known.select("item", "width"), broadcast_rows), "item")
    wide = wide.select("row", "doc_id", "item", "width", words_of(F.col("text")).alias("words"))
    wide = kept(wide.select("row", "doc_id", "item", shingles_of("words", F.col("width")).alias("hs")))
    wide = wide.join(bounded(known, broadcast_rows // 10), "item")
    # No filter between these steps: pushed down, it would repeat the work above it for each row.
    n = F.size("hs")
    long = F.least("m", n)  # shingles in a window
    wide = wide.withColumn("long", long).withColumn(
        "need", F.ceil(F.lit(percent) * (long + F.col("m")) / (100 + percent)).cast("int")
    )
    none = F.array().cast("array<int>")
    seeds = F.filter(F.sequence(F.lit(1), n), lambda i: F.array_contains("distinct", F.element_at("hs", i)))
    wide = wide.withColumn("seeds", F.when(n > 0, seeds).otherwise(none))
    last = F.size("seeds") - F.col("need") + 1
    enough = F.filter(
        F.sequence(F.lit(1), last),
        lambda a: F.element_at("seeds", a + F.col("need") - 1) - F.element_at("seeds", a) < F.col("long"),
    )
    starts = F.transform(
        enough, lambda a: F.greatest(F.lit(1), F.least(F.element_at("seeds", a), F.size("hs") - F.col("long") + 1))
    )
    starts = F.when(last >= 1, F.array_distinct(starts)).otherwise(none)
    windows = F.transform(starts, lambda t: F.struct(t.alias("t"), F.slice("hs", t, F.col("long")).alias("w")))
    signed = F.transform(
        windows, lambda w: F.struct(w["t"].alias("t"), w["w"].alias("w"), simhash(w["w"]).alias("bits"))
    )
    measured = F.transform(
        signed,
        lambda w: F.struct(
            w["t"].alias("t"),
            w["w"].alias("w"),
            w["bits"].alias("bits"),
            F.bit_count(w["bits"].bitwiseXOR(F.col("simhash"))).alias("distance"),
        ),
    )
    near = F.filter(
        measured,
        lambda w: F.arrays_overlap(block_codes(w["bits"], 0), F.col("index")) & (w["distance"] <= RADIUS),
    )

    def shared(w: Column) -> Column:
        return F.aggregate(
            F.arrays_zip("distinct", "counts"),
            F.lit(0),
            lambda total, s: total + F.least(F.size(F.filter(w, lambda x: x == s["distinct"])), s["counts"]),
        )

    told = F.transform(
        near,
        lambda w: F.struct(shared(w["w"]).alias("both"), (-w["t"]).alias("minus_t"), w["distance"].alias("distance")),
    )
    best = checkpointed(wide.select("row", "doc_id", "item_id", "m", "long", F.array_max(told).alias("best")))
    both, either = F.col("best.both"), F.col("long") + F.col("m") - F.col("best.both")
    return best.where(100 * both >= percent * either).select(
        "row",
        "doc_id",
        "item_id",
        (both / either).alias("similarity"),
        (-F.col("best.minus_t") - 1).cast("long").alias("window_start"),
        F.col("best.distance").alias("distance"),
    )


def without_leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that leak an item; columns and other rows stay."""
    bad = checkpointed(leaks(docs, items, key, text, **options).select("row").distinct())
    bad = bad.withColumnRenamed("row", "_row")
    rows = docs.withColumn("_row", F.xxhash64(col(key).cast("long"), col(text).cast("string")))
    names = [col(c) for c in docs.columns]
    clean = in_buckets(rows, bad, "_row", "left_anti").select(*names)
    return clean.unionByName(in_buckets(rows, bad, "_row").join(bad, "_row", "left_anti").select(*names))
