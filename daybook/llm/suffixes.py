"""Removal of repeated byte strings with a logarithmic family of suffix indexes.

A string of ``length`` bytes that starts at two places (of one text or of two)
is removed wherever it stands. All sizes are in UTF-8 bytes.

1. Each text's sampled suffixes (``windows.py``) are its index entries: equal
   windows always share one at the same offset, so a sparse suffix array
   suffices. Entries are ordered by the hash of their first ``k`` bytes;
   only equality of long strings matters here, not lexicographic order.
2. Texts come in batches. A batch's sorted run is merge-scanned against the
   levels of the index: equal keys of two runs are matches of ``k`` bytes. Runs
   and levels of equal size merge into the next level, as digits carry in a
   binary counter, so a key is rewritten a logarithmic number of times.
3. Entries with a repeated key are compared further: where the whole extent of
   an entry (all bytes of its windows) is equal elsewhere, all its windows are
   repeated. Entries whose key has several extents and whose own extent is
   single lie at the border of a repeat; the bytes around these, and around
   one entry for each other extent of the key, are brought together by key and
   compared window by window.
4. Repeated windows give the runs to remove.

Copies meet only as counts. A key with up to ``group`` different extents is
compared in one task; beyond that its windows are counted one by one in a
shuffle, which gives the same answer without gathering them. Filters that
keep texts or entries from being shuffled (bitmaps of hashes, a table of row
buckets) have a fixed size and let false positives through, never drop; where
it matters, an exact lookup follows for the few that they cannot decide.
Strings count as equal when their 64-bit hashes are.

Defined results: NULL text is empty; texts shorter than ``length`` bytes keep
everything; rows that repeat id and text repeat each other's strings.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import arrow_schema, checkpointed, chunks, col, in_buckets, kept, map_arrow, map_texts
from daybook.llm.windows import Suffixes, U, Hashes, mixed, sample

KEY_BITS = 26  # size of the bitmaps: 2**26 bits (8 MB)


def with_row(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``doc_id, text, row``; ``row`` names id and text, so equal rows share it."""
    narrow = docs.select(
        col(key).cast("long").alias("doc_id"), F.coalesce(col(text).cast("string"), F.lit("")).alias("text")
    )
    return narrow.withColumn("row", F.xxhash64("doc_id", "text"))


def sampled(rows: DataFrame, length: int, k: int, emit: Callable, fields: str) -> DataFrame:
    """``emit(suffixes, row of each suffix)`` over the sampled suffixes of all texts.

    They are sampled anew in each pass: that costs less than keeping them.
    """
    schema = arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, texts in chunks(batches):
            s = sample([t.encode() for t in texts], length, k)
            columns = emit(s, np.array(row, dtype=np.int64)[s.row])
            arrays = [pa.array(c.view(np.int64) if c.dtype == U else c, f.type) for c, f in zip(columns, schema)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return map_arrow(rows.select("row", "text").where(F.octet_length("text") >= length), run, fields)


class SuffixIndex:
    """Levels of sorted runs (``key, n``): level ``i`` holds the keys of ``2 ** i`` batches, or is empty."""

    def __init__(self) -> None:
        self.levels: dict[int, DataFrame] = {}
        self.scans: list[DataFrame] = []

    def add(self, keys: DataFrame) -> None:
        """Index a batch (``key`` per suffix): scan it against all levels, then carry."""
        run = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        carry = 0
        while carry in self.levels:
            carry += 1
        others = [level for i, level in self.levels.items() if i > carry]
        if others:
            run = kept(run.sortWithinPartitions("key"))
            self.scans += [checkpointed(run.select("key").join(level, "key", "left_semi")) for level in others]
        merging = [self.levels.pop(i) for i in range(carry)]
        if merging:
            run = reduce(DataFrame.unionByName, [run, *merging]).groupBy("key").agg(F.sum("n").alias("n"))
        if merging or not others:
            run = kept(run.sortWithinPartitions("key"))
        self.levels[carry] = run

    def repeated(self) -> DataFrame:
        """Keys that were met at two places (a key may come more than once)."""
        own = [level.where("n > 1").select("key") for level in self.levels.values()]
        return reduce(DataFrame.unionByName, [*own, *self.scans])


def bitmap(values: DataFrame, column: str, bits: int) -> np.ndarray:
    """Bits set at the leading ``bits`` bits of the values; a fixed 2**bits bits, however many rows."""
    place = F.shiftrightunsigned(column, 64 - bits) + 1
    rows = (
        values.select(F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("bit"))
        .groupBy("bucket")
        .agg(F.bitmap_construct_agg("bit").alias("map"))
        .collect()
    )
    out = np.zeros(max(1 << bits >> 3, 4096), dtype=np.uint8)
    for r in rows:
        at = (r.bucket - 1) * 4096
        out[at : at + 4096] = np.frombuffer(r.map, dtype=np.uint8)
    return out


def in_bitmap(bits_set: np.ndarray, keys: np.ndarray, bits: int) -> np.ndarray:
    place = (keys.view(U) >> U(64 - bits)).astype(np.int64)
    return (bits_set[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def in_map(df: DataFrame, column: str, bits_set: np.ndarray) -> DataFrame:
    """Rows of numbers whose ``column`` is in the bitmap."""
    at = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(in_bitmap(bits_set, b.column(at).to_numpy(), KEY_BITS)))

    return map_arrow(df, run, df.schema)


def whole_extents(
    rows: DataFrame, extents: DataFrame, key_bits: np.ndarray, length: int, k: int
) -> DataFrame:
    """``row, lo, hi`` of the entries whose whole extent is repeated, adjacent ones as one.

    Two bitmaps decide without a shuffle: an entry is repeated only if its
    extent is in that of the repeated extents, and certainly so if it is not
    in that of the single extents that the first one lets through. What is
    in both is looked up in ``extents``.
    """
    again = extents.where("n > 1").select("extent")
    again_bits = bitmap(again, "extent", KEY_BITS)
    doubt_bits = bitmap(in_map(extents.where("n = 1").select("extent"), "extent", again_bits), "extent", KEY_BITS)

    def emit(s: Suffixes, row: np.ndarray) -> list[np.ndarray]:
        may = in_bitmap(key_bits, s.key, KEY_BITS) & in_bitmap(again_bits, s.extent, KEY_BITS)
        doubt = may & in_bitmap(doubt_bits, s.extent, KEY_BITS)
        sure = may & ~doubt
        text, lo, hi = s.row[sure], s.lo[sure], s.hi[sure]
        new = np.ones(len(lo), dtype=bool)
        new[1:] = (text[1:] != text[:-1]) | (lo[1:] != hi[:-1] + 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(lo))[: len(first)] - 1
        return [
            np.concatenate([row[sure][first], row[doubt]]),
            np.concatenate([lo[first], s.lo[doubt]]),
            np.concatenate([hi[last], s.hi[doubt]]),
            np.concatenate([np.zeros(len(first), np.int64), s.extent.view(np.int64)[doubt]]),
            np.concatenate([np.ones(len(first), bool), np.zeros(int(doubt.sum()), bool)]),
        ]

    found = kept(sampled(rows, length, k, emit, "row long, lo long, hi long, extent long, sure boolean"))
    looked_up = found.where("not sure").join(again, "extent", "left_semi")
    return found.where("sure").unionByName(looked_up.select(*found.columns)).select("row", "lo", "hi")


def border_entries(
    rows: DataFrame, extents: DataFrame, length: int, k: int, group: int
) -> DataFrame:
    """One entry of each extent whose key has several: ``key, target, many, row, at, back, fore``.

    ``target``: the extent is single, so its windows have to be compared one by one.
    """
    several = kept(extents.groupBy("key").agg(F.count(F.lit(1)).alias("extents")).where("extents > 1"))
    told = kept(
        in_buckets(extents, several, "key")
        .join(several, "key")
        .select("extent", "key", "n", (F.col("extents") > group).alias("many"))
    )
    bits_set = bitmap(told, "extent", KEY_BITS)

    def emit(s: Suffixes, row: np.ndarray) -> list[np.ndarray]:
        use = in_bitmap(bits_set, s.extent, KEY_BITS)
        return [x[use] for x in (s.extent, row, s.at, s.at - s.lo, s.at - s.hi)]

    found = sampled(rows, length, k, emit, "extent long, row long, at long, back int, fore int")
    # One entry of each extent, combined in each task before it is shuffled: a hot extent stays small.
    one = found.groupBy("extent").agg(F.min(F.struct("row", "at", "back", "fore")).alias("e"))
    return one.join(told, "extent").select("key", (F.col("n") == 1).alias("target"), "many", "e.*")


def contexts(rows: DataFrame, border: DataFrame, length: int) -> DataFrame:
    """The bytes that the windows of each border entry cover: ``key, target, row, start, back, fore, bytes``."""
    lists = border.groupBy("row").agg(F.collect_list(F.struct("key", "target", "many", "at", "back", "fore")).alias("e"))
    met = in_buckets(rows, border, "row").join(lists, "row").select("row", "text", "e")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, texts, found in chunks(batches):
            out: list[list] = [[] for _ in range(8)]
            for r, t, es in zip(row, texts, found):
                data = t.encode()
                for e in es:
                    lo, hi = e["at"] - e["back"], e["at"] - e["fore"]
                    bits = data[lo : hi + length]
                    for c, v in zip(out, (e["key"], e["target"], e["many"], r, lo, e["back"], e["fore"], bits)):
                        c.append(v)
            kinds = (
                pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()
            )
            names = ["key", "target", "many", "row", "start", "back", "fore", "bytes"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names=names)

    return map_arrow(
        met, run, "key long, target boolean, many boolean, row long, start long, back int, fore int, bytes binary"
    )


def window_hashes(
    key: np.ndarray, back: np.ndarray, fore: np.ndarray, data: list[bytes], length: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all windows of all entries: entry number, number in the entry, hash of key, offset and bytes."""
    sizes = np.array([len(x) for x in data], dtype=np.int64)
    begin = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    n = back.astype(np.int64) - fore + 1
    entry = np.repeat(np.arange(len(n)), n)
    number = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    at = begin[entry] + number
    h = Hashes(np.frombuffer(b"".join(data), dtype=np.uint8)).of(at, at + length)
    offset = (back[entry].astype(np.int64) - number).astype(U)
    return entry, number, mixed(h ^ mixed(key.view(U)[entry] + offset))


def runs_of(entry: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of consecutive numbers: entry, first, last (input sorted by both)."""
    if not len(entry):
        return entry, number, number
    new = np.ones(len(entry), dtype=bool)
    new[1:] = (entry[1:] != entry[:-1]) | (number[1:] != number[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(entry)) - 1
    return entry[first], number[first], number[last]


def compared(near: DataFrame, length: int, most: int = 4_000) -> DataFrame:
    """Repeated windows of the targets, compared within groups of one key: ``row, lo, hi``."""

    def work(held: list[dict]) -> pa.RecordBatch:
        key = np.array([e["key"] for e in held], dtype=np.int64)
        back = np.array([e["back"] for e in held], dtype=np.int32)
        fore = np.array([e["fore"] for e in held], dtype=np.int32)
        entry, number, h = window_hashes(key, back, fore, [e["bytes"] for e in held], length)
        order = np.argsort(h, kind="stable")
        same = np.zeros(len(h) + 1, dtype=bool)
        same[1:-1] = h[order][1:] == h[order][:-1]
        again = np.zeros(len(h), dtype=bool)
        again[order] = same[1:] | same[:-1]
        again &= np.array([e["target"] for e in held])[entry]
        e, first, last = runs_of(entry[again], number[again])
        row = np.array([x["row"] for x in held], dtype=np.int64)
        start = np.array([x["start"] for x in held], dtype=np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(row[e]), pa.array(start[e] + first), pa.array(start[e] + last)], names=["row", "lo", "hi"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for b in batches:  # sorted by key: a group is complete when the key changes
            for e in b.to_pylist():
                if len(held) >= most and e["key"] != held[-1]["key"]:
                    yield work(held)
                    held = []
                held.append(e)
        if held:
            yield work(held)

    dealt = near.repartition("key").sortWithinPartitions("key")
    return map_arrow(dealt, run, "row long, lo long, hi long")


def counted(near: DataFrame, length: int) -> DataFrame:
    """The same as ``compared`` for keys of any size: windows are counted one by one, none are gathered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            c = {name: b.column(i) for i, name in enumerate(b.schema.names)}
            entry, number, h = window_hashes(
                c["key"].to_numpy(), c["back"].to_numpy(), c["fore"].to_numpy(), c["bytes"].to_pylist(), length
            )
            target = c["target"].to_numpy(zero_copy_only=False)[entry]
            start = c["start"].to_numpy()[entry] + number
            yield pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), pa.array(target), pa.array(c["row"].to_numpy()[entry]), pa.array(start)],
                names=["h", "target", "row", "lo"],
            )

    windows = map_arrow(near, run, "h long, target boolean, row long, lo long")
    again = windows.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("h")
    return windows.where("target").join(again, "h").select("row", "lo", F.col("lo").alias("hi"))


def repeated_windows(
    rows: DataFrame, length: int, k: int, batches: int, group: int
) -> DataFrame:
    """``row, lo, hi``: windows starting in ``[lo, hi]`` of the row's text are repeated somewhere."""
    index = SuffixIndex()
    for i in range(batches):
        batch = rows.where(F.pmod("row", F.lit(batches)) == i)
        index.add(sampled(batch, length, k, lambda s, row: [s.key], "key long"))
    key_bits = bitmap(index.repeated(), "key", KEY_BITS)

    def emit(s: Suffixes, row: np.ndarray) -> list[np.ndarray]:
        use = in_bitmap(key_bits, s.key, KEY_BITS)
        return [s.extent[use], s.key[use]]

    # Equal extents have equal keys: what a text's bytes pick depends on them alone.
    candidates = sampled(rows, length, k, emit, "extent long, key long")
    extents = kept(candidates.groupBy("extent").agg(F.first("key").alias("key"), F.count(F.lit(1)).alias("n")))
    border = kept(border_entries(rows, extents, length, k, group))
    near = kept(contexts(rows, border, length))
    parts = [whole_extents(rows, extents, key_bits, length, k), compared(near.where("not many"), length)]
    many = near.where("many")
    if not many.isEmpty():
        parts.append(counted(many, length))
    return kept(reduce(DataFrame.unionByName, parts))


def without_repeats(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    length: int = 200,
    k: int = 64,
    batches: int = 4,
    group: int = 16_384,
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_bytes``, the removed runs (``starts``, ``ends``) and the ``kept`` bytes.

    A byte goes when it lies in a string of ``length`` bytes that also starts
    elsewhere, judged on the input as it is.
    """
    rows = with_row(docs, key, text)
    repeated = repeated_windows(rows, length, k, batches, group)
    lists = repeated.groupBy("row").agg(F.collect_list(F.struct("lo", "hi")).alias("w"))
    met = in_buckets(rows, repeated, "row").join(lists, "row", "left")
    met = met.select("doc_id", "text", F.col("w.lo").alias("lo"), F.col("w.hi").alias("hi"))

    def work(ids: list, texts: list, los: list, his: list) -> list:
        out: list[list] = [[], [], [], []]
        for t, lo, hi in zip(texts, los, his):
            data = t.encode()
            starts, ends = removed(lo or [], hi or [], length)
            at, left = 0, []
            for s, e in zip(starts, ends):
                left.append(data[at:s])
                at = e
            left.append(data[at:])
            for c, v in zip(out, (len(data), starts, ends, b"".join(left))):
                c.append(v)
        return [ids, *out]

    fields = "doc_id long, n_bytes long, starts array<long>, ends array<long>, kept binary"
    changed = map_texts(met, work, fields)
    none = F.array().cast("array<long>")
    same = in_buckets(rows, repeated, "row", "left_anti").select(
        "doc_id",
        F.octet_length("text").cast("long").alias("n_bytes"),
        none.alias("starts"),
        none.alias("ends"),
        F.encode("text", "UTF-8").alias("kept"),
    )
    return changed.unionByName(same)


def removed(lo: list[int], hi: list[int], length: int) -> tuple[list[int], list[int]]:
    """Maximal runs of bytes covered by the windows that start in the given ranges."""
    starts: list[int] = []
    ends: list[int] = []
    for a, b in sorted(zip(lo, hi)):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b + length)
        else:
            starts.append(a)
            ends.append(b + length)
    return starts, ends


def digests(cut: DataFrame) -> DataFrame:
    gone = F.aggregate(
        F.zip_with("starts", "ends", lambda s, e: e - s), F.lit(0).cast("long"), lambda total, x: total + x
    )
    return cut.select(
        "doc_id",
        "n_bytes",
        gone.alias("n_removed"),
        F.size("starts").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
