"""Byte-pair encoding by content-defined chunks, and decoding.

A text is cut where a rolling hash of its last 16 bytes has its top bits zero,
so equal passages of different documents are cut alike whatever stands before
them. A worker encodes each distinct chunk once for all documents that it
meets (a cache bounded in code points keeps chunks from slice to slice); a
document's ids are then its chunks' ids with the joins repaired.

Repairing a join. Where letters, digits or a run without white space end, a
pre-token ends whatever the context is (``SAFE``), so a token ends there in
each chunk and in the whole text. The stretch from the left chunk's last such
place to the right chunk's first one is encoded anew; it has to meet a token's
end of both chunks' own ids, and takes the place of the ids between. A chunk
without such a place (one long run of letters) is joined to its neighbour and
encoded with it, and a text without agreement is encoded whole, until all
joins agree. The result is the library's, exactly.

Ids and decoding: strings of special tokens inside a text become their ids, as
the library does by default. Decoding joins the tokens' bytes and reads them as
UTF-8, with U+FFFD for what is none; ids without a token are skipped.

Defined results: a NULL text is the empty text, with an empty array of ids; a
NULL array, and NULL in one, decode to nothing. Repeated rows give repeated
rows. Texts are encoded whole, however long.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import col, map_arrow, slices
from daybook.llm.tokencount import SPLIT, byte_symbols

SPAN = 16  # bytes of the rolling hash
CUT_BITS = 9  # a cut about every 512 bytes
LEAST, MOST = 64, 4096  # bytes of a chunk; LEAST > SPAN, so that no hash reaches into the text before
BLOCK = 1 << 22  # bytes hashed at once
TEXT_AT_ONCE = 4_000_000  # bytes of text handled at once
CACHE_CHUNKS = 4_000_000  # code points of chunks remembered by a worker, at least (a cache, not a cap on results)
IDS_PER_SLICE = 1_000_000  # ids decoded at once

# Places where a pre-token ends in any context: before what does not go on with the letters, digits or
# characters other than white space that stand before it.
SAFE = r"(?<=\p{L})\P{L}|(?<=\p{N})\P{N}|(?<=\S)\s"


def hash_cuts(data: np.ndarray, span: int = SPAN, bits: int = CUT_BITS) -> np.ndarray:
    """Offsets after which the hash of the last ``span`` bytes has its top ``bits`` bits zero, between code points."""
    found = []
    for at in range(0, len(data), BLOCK):
        low = max(0, at - span + 1)
        h = (data[low : at + BLOCK].astype(np.uint32) + np.uint32(1)) * np.uint32(0x9E3779B1)
        factor, reach = 0x01000193, 1
        while reach < span:  # h[i] covers bytes i - 2 * reach + 1 .. i
            h[reach:] += h[:-reach] * np.uint32(factor)
            factor, reach = factor * factor & 0xFFFFFFFF, reach * 2
        hit = np.flatnonzero(h >> np.uint32(32 - bits) == 0) + low + 1
        found.append(hit[hit > at])
    cuts = np.concatenate(found) if found else np.zeros(0, np.int64)
    cuts = cuts[cuts < len(data)]
    return cuts[(data[cuts] & 0xC0) != 0x80]


def chunked(parts: list[str]) -> list[list[str]]:
    """Each text as its content-defined chunks."""
    raw = [p.encode() for p in parts]
    joined = b"".join(raw)
    cuts = hash_cuts(np.frombuffer(joined, dtype=np.uint8)).tolist() if any(len(r) > LEAST for r in raw) else []
    out, start, i = [], 0, 0
    for r in raw:
        end, edges = start + len(r), [start]
        while i < len(cuts) and cuts[i] < end:
            edges += _forced(joined, edges[-1], cuts[i])
            if cuts[i] - edges[-1] >= LEAST and end - cuts[i] >= LEAST:
                edges.append(cuts[i])
            i += 1
        edges += _forced(joined, edges[-1], end)
        out.append([joined[a:b].decode() for a, b in zip(edges, [*edges[1:], end])] if r else [])
        start = end
    return out


def _forced(joined: bytes, start: int, end: int) -> list[int]:
    """Cuts that leave at most MOST bytes to a chunk between ``start`` and ``end``, between code points."""
    cuts = []
    while end - start > MOST + LEAST:
        start += MOST
        while joined[start] & 0xC0 == 0x80:
            start -= 1
        cuts.append(start)
    return cuts


class Vocabulary:
    """The tokens' bytes of a byte-level BPE tokenizer file, in one row of bytes."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec["pre_tokenizer"]
        level = pre["type"] == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]
        plain = not any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"])
        if spec["model"]["type"] != "BPE" or not level or spec["normalizer"] or not plain:
            raise ValueError("a byte-level BPE tokenizer without a normalizer is needed")
        byte = {c: b for b, c in enumerate(byte_symbols())}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        tokens = {i: bytes(byte[c] for c in t) for t, i in spec["model"]["vocab"].items() if t not in self.special}
        tokens |= {i: t.encode() for t, i in self.special.items()}
        row = [tokens.get(i, b"") for i in range(max(tokens) + 2)]  # the last number stands for ids without a token
        self.sizes = np.array([len(t) for t in row], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(row), dtype=np.uint8)

    def ranks(self) -> dict[bytes, int]:
        """Token -> id, without the special ones: a merge's rank is its token's id."""
        raw, special = self.data.tobytes(), set(self.special.values())
        ends = zip(self.starts.tolist(), self.sizes.tolist())
        return {raw[a : a + n]: i for i, (a, n) in enumerate(ends) if n and i not in special}

    def decode(self, lists: pa.ListArray) -> pa.Array:
        """The texts of lists of ids: the tokens' bytes gathered for all lists at once."""
        counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ids = pc.fill_null(lists.flatten(), -1).to_numpy(zero_copy_only=False)
        none = len(self.sizes) - 1
        ids = np.where((ids >= 0) & (ids < none), ids, none)
        size = self.sizes[ids]
        ends = np.cumsum(size)
        at = np.repeat(self.starts[ids] - (ends - size), size)
        at += np.arange(len(at))
        data = self.data[at]
        offsets = np.append(0, ends)[np.append(0, np.cumsum(counts))]
        texts = pa.StringArray.from_buffers(len(counts), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data))
        try:
            texts.validate(full=True)
            return texts
        except pa.ArrowInvalid:  # some bytes are no UTF-8
            raw = data.tobytes()
            return pa.array([raw[a:b].decode("utf-8", "replace") for a, b in zip(offsets, offsets[1:])], pa.string())


class Chunk:
    """A chunk encoded alone. ``first`` and ``last``: its first and last safe place, as code points and as ids before it."""

    __slots__ = ("text", "ids", "first", "last")

    def __init__(self, text: str, ids: np.ndarray, first: tuple[int, int] | None, last: tuple[int, int] | None) -> None:
        self.text, self.ids, self.first, self.last = text, ids, first, last


class Codec:
    """A byte-level BPE tokenizer with a worker's cache of chunks."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import tiktoken
        from tokenizers import Tokenizer

        self.words = words = Vocabulary(path)
        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        # The same merges by rank, for short stretches of text.
        self.short = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=words.ranks(), special_tokens={}).encode_ordinary
        self.sizes = words.sizes
        self.special = words.special
        names = sorted(self.special, key=len, reverse=True)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.safe_first = regex.compile(SAFE).search
        self.safe_last = regex.compile("(?r)" + SAFE).search
        self.young: dict[str, Chunk] = {}
        self.old: dict[str, Chunk] = {}
        self.young_size = 0

    def encoded(self, text: str) -> Chunk:
        """A chunk encoded alone; one of several chunks joined (beyond MOST) by the library."""
        alone = self.short(text) if len(text) <= MOST + LEAST else self.library.encode(text, add_special_tokens=False).ids
        ids = np.array(alone, dtype=np.int32)
        first, last = self.safe_first(text), self.safe_last(text)
        if not first:
            return Chunk(text, ids, None, None)
        ends = np.cumsum(self.sizes[ids])
        places = [(m.start(), len(text[: m.start()].encode())) for m in (first, last)]
        at = np.searchsorted(ends, [b for _, b in places])
        if any(ends[i] != b for i, (_, b) in zip(at, places)):  # no agreement
            return Chunk(text, ids, None, None)
        return Chunk(text, ids, *((c, int(i) + 1) for i, (c, _) in zip(at, places)))

    def chunk(self, text: str) -> Chunk:
        """``encoded``, from the cache where the chunk was met before."""
        found = self.young.get(text)
        if not found:
            found = self.old.get(text) or self.encoded(text)
            self.young[text] = found
            self.young_size += len(text)
            if self.young_size > CACHE_CHUNKS:
                self.old, self.young, self.young_size = self.young, {}, 0
        return found

    def part(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of the text that the chunks ``texts`` make up, in pieces."""
        row = [self.chunk(t) for t in texts]
        if len(row) > 1 and not all(c.first for c in row):
            groups: list[list[Chunk]] = []
            for c in row:
                if groups and not (c.first and any(g.first for g in groups[-1])):
                    groups[-1].append(c)
                else:
                    groups.append([c])
            row = [g[0] if len(g) == 1 else self.encoded("".join(c.text for c in g)) for g in groups]
            if len(row) > 1 and not all(c.first for c in row):
                row = [self.encoded("".join(texts))]
        pieces, begin = [], 0
        for left, right in zip(row, row[1:]):
            pieces.append(left.ids[begin : left.last[1]])
            pieces.append(np.array(self.short(left.text[left.last[0] :] + right.text[: right.first[0]]), dtype=np.int32))
            begin = right.first[1]
        pieces += [c.ids[begin:] for c in row[-1:]]
        return pieces

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the number of ids before each text (and after the last)."""
        owner, parts = [], []
        for i, t in enumerate(texts):
            pieces = self.marks.split(t) if self.marks and self.marks.search(t) else [t]
            owner += [i] * len(pieces)
            parts += pieces
        cut = iter(chunked([p for p in parts if p not in self.special]))
        out, counts = [np.zeros(0, np.int32)], np.zeros(len(texts) + 1, dtype=np.int64)
        for i, p in zip(owner, parts):
            pieces = [np.array([self.special[p]], dtype=np.int32)] if p in self.special else self.part(next(cut))
            out += pieces
            counts[i + 1] += sum(map(len, pieces))
        return np.concatenate(out), np.cumsum(counts)


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id, ids`` (array of int), as the library gives them without added special tokens.

    ``tokenizer`` is the path of a byte-level BPE ``.json`` file that every executor can open.
    """
    return _coded(docs, tokenizer, key, text, False)


def encode_and_decode(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``encode``, with the text that the ids are decoded to: ``doc_id, ids, text``. One worker does both."""
    return _coded(docs, tokenizer, key, text, True)


def _coded(docs: DataFrame, tokenizer: str, key: str, text: str, both: bool) -> DataFrame:
    narrow = docs.select(col(key).cast("long").alias("doc_id"), col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1, TEXT_AT_ONCE):
            c = codec(tokenizer)
            ids, counts = c.encode([t or "" for t in part.column(1).to_pylist()])
            lists = pa.ListArray.from_arrays(pa.array(counts, pa.int32()), pa.array(ids, pa.int32()))
            columns = [part.column(0), lists, c.words.decode(lists)] if both else [part.column(0), lists]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "text"][: len(columns)])

    return map_arrow(narrow, run, "doc_id long, ids array<int>" + ", text string" * both)


def decode(rows: DataFrame, tokenizer: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """``rows`` with the column ``ids`` replaced by the ``text`` that the ids stand for; other columns stay."""
    names = [c for c in rows.columns if c != ids]
    plain = rows.select(col(ids).cast("array<int>").alias("c"), *[col(c).alias(f"c{i}") for i, c in enumerate(names)])
    shown = plain.withColumn("c", F.lit(""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 0, IDS_PER_SLICE, pc.list_value_length):
            columns = [vocabulary(tokenizer).decode(part.column(0)), *part.columns[1:]]
            yield pa.RecordBatch.from_arrays(columns, names=part.schema.names)

    out = map_arrow(plain, run, shown.schema)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], F.col("c").alias(text))


def round_trip(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_tokens``, the digest of its ids and that of the text decoded from them."""
    rows = encode_and_decode(docs, tokenizer, key, text)
    joined = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )
