"""SentencePiece encoding by forward filtering and backward sampling, and decoding.

All segmentations of a text form a lattice: nodes are places between
characters, edges are pieces. The forward pass sums the weights of all paths
to each node, the backward pass draws a segmentation from the end, each piece
with its share of the sum, so that a segmentation comes up in proportion to
the product of its pieces' probabilities (to the power ``alpha``). The random
numbers depend on the row's key, the unit's number in the text and the step
alone: the same row gives the same pieces in any partition or batch.

No piece continues past a space, so the lattice falls apart into units (spaces
and the word after them). Units are numbered per chunk of texts; the lattices
of the distinct ones are built together in numpy, and the backward pass walks
all occurrences at once, one step for all. A unit of more than ``LONG``
characters (a text without spaces) would be as many steps with one unit each:
it is walked on its own, node by node, in both passes.

A node's shares are whole numbers of 2**32 and so are the random numbers: where
a unit stands among others changes no rounding and no draw.

Characters without a piece are spelled in byte pieces, also a literal ``▁``, so
decoding gives back every text exactly.

Defined results: NULL and empty texts have no pieces (decoded: empty); a row
without key is seeded as key 0; equal rows get equal pieces.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from functools import lru_cache
from math import exp, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from daybook.llm.common import col, map_arrow, map_texts

U = np.uint64
SPACE, LITERAL = 0x2581, 0x110000  # the sign that stands for a space; a literal one matches no piece
UNIT = re.compile(" *[^ ]+| +")
STEP = U(0x9E3779B97F4A7C15)
TEXT_AT_ONCE = 1_500_000
LONG = 400  # characters
SHARE_BITS = 32


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Lattices:
    """Lattices of many units at once: per node, its incoming edges with their cumulated probabilities."""

    def __init__(self, units: list[str], model: "Pieces") -> None:
        text = "".join(units)
        code = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        code = np.where(code == SPACE, LITERAL, code)
        code[code == 32] = SPACE
        size = np.array([len(u) for u in units], dtype=np.int64)
        first = np.cumsum(size) - size
        unit = np.repeat(np.arange(len(units)), size)
        local = np.arange(len(code)) - first[unit]
        left = size[unit] - local
        self.base = first + np.arange(len(units))  # a unit of n characters has n + 1 nodes
        self.end = self.base + size
        node = np.arange(len(code)) + unit

        at, h = np.arange(len(code)), np.zeros(len(code), dtype=U)
        starts, ends, ids, weights, depths = [], [], [], [], []
        single = np.zeros(len(code), dtype=bool)
        for n in range(1, model.longest + 1):
            use = left[at] >= n
            at, h = at[use], h[use]
            h = mixed(h * STEP + code[at + n - 1].astype(U) + U(1))
            keys, found_id = model.prefixes[n - 1]
            place = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            use = keys[place] == h
            at, h, place = at[use], h[use], place[use]
            piece = found_id[place]
            whole = piece >= 0
            where = at[whole]
            starts.append(node[where])
            ends.append(node[where] + n)
            ids.append(piece[whole])
            weights.append(model.weight[piece[whole]])
            depths.append(local[where] + n)
            if n == 1:
                single[where] = True
        bare = np.flatnonzero(~single)
        point = np.where(code[bare] == LITERAL, SPACE, code[bare])
        long = 1 + (point > 0x7F) + (point > 0x7FF) + (point > 0xFFFF)
        starts.append(node[bare])
        ends.append(node[bare] + 1)
        ids.append(np.where(point < 128, model.byte_id[np.minimum(point, 255)], -1 - point))
        weights.append(long * model.byte_weight)
        depths.append(local[bare] + 1)

        small = np.int32  # nodes and pieces of one chunk
        start, end, piece, depth = (np.concatenate(x).astype(small) for x in (starts, ends, ids, depths))
        weight = np.concatenate(weights)
        del starts, ends, ids, weights, depths
        order = np.argsort(end, kind="stable")  # each piece length is in order already: a merge of runs
        self.start, end, self.piece, weight, depth = (x[order] for x in (start, end, piece, weight, depth))
        total = np.full(len(code) + len(units), -np.inf)
        total[self.base] = 0.0
        self.long = size > LONG
        deepest = int(size[~self.long].max(initial=0))
        self.forward(total, end, weight, depth, deepest)

        share = np.exp(total[self.start] + weight - total[end])
        share = np.minimum((share * 2.0**SHARE_BITS).astype(np.int64), 1 << SHARE_BITS)
        n_edges = np.bincount(end, minlength=len(total))
        self.last = np.cumsum(n_edges) - 1  # last incoming edge of each node
        sums = np.cumsum(share)
        first = self.last - n_edges + 1
        before = np.where(first > 0, sums[np.maximum(first - 1, 0)], 0)
        upto = np.minimum(sums - before[end], 1 << SHARE_BITS)
        upto[self.last[n_edges > 0]] = 1 << SHARE_BITS  # whatever rounding left over
        self.limit = (end.astype(np.int64) << (SHARE_BITS + 1)) + upto

    def forward(self, total: np.ndarray, end: np.ndarray, weight: np.ndarray, depth: np.ndarray, deepest: int) -> None:
        """Fills in ``total``, the logarithm of the weight of all paths to each node."""
        walked = np.zeros(len(total), dtype=bool)
        for k in np.flatnonzero(self.long).tolist():
            walked[self.base[k] : self.end[k] + 1] = True
            a, b = np.searchsorted(end, [self.base[k] + 1, self.end[k] + 1])
            total[self.base[k] : self.end[k] + 1] = _walk_forward(
                (self.start[a:b] - self.base[k]).tolist(), (end[a:b] - self.base[k]).tolist(), weight[a:b].tolist()
            )
        depth = np.where(walked[end], 0, depth)
        order = np.argsort(depth.astype(np.int16), kind="stable")
        cuts = np.searchsorted(depth[order], np.arange(1, deepest + 2))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):  # all units' nodes of one depth
            edges = order[a:b]
            e = end[edges]
            group = np.flatnonzero(np.append(True, e[1:] != e[:-1]))
            value = total[self.start[edges]] + weight[edges]
            top = np.maximum.reduceat(value, group)
            sums = np.add.reduceat(np.exp(value - np.repeat(top, np.diff(np.append(group, b - a)))), group)
            total[e[group]] = top + np.log(sums)

    def draw(self, unit: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of each occurrence in order, and their number per occurrence."""
        node, stop = self.end[unit].copy(), self.base[unit]
        places, found, steps = [], [], []
        count = np.zeros(len(unit), dtype=np.int64)
        for i in np.flatnonzero(self.long[unit]).tolist():
            drawn = self._walk_back(int(unit[i]), seed[i])
            places.append(np.full(len(drawn), i, dtype=np.int32))
            found.append(np.array(drawn, dtype=np.int32))
            steps.append(np.arange(len(drawn), dtype=np.int32))
            count[i] = len(drawn)
        open_, step = np.flatnonzero(~self.long[unit]), 0
        while len(open_):
            u = (mixed(seed[open_] + np.array([step], dtype=U) * STEP) >> U(64 - SHARE_BITS)).astype(np.int64)
            e = np.searchsorted(self.limit, (node[open_] << (SHARE_BITS + 1)) + u, side="right")
            places.append(open_.astype(np.int32))
            found.append(self.piece[e])
            steps.append(np.full(len(open_), step, dtype=np.int32))
            count[open_] += 1
            node[open_] = self.start[e]
            open_ = open_[node[open_] > stop[open_]]
            step += 1
        out = np.zeros(int(count.sum()), dtype=np.int32)
        if len(out):
            place, step_of = np.concatenate(places), np.concatenate(steps)
            out[np.cumsum(count)[place] - 1 - step_of] = np.concatenate(found)  # drawn from the end
        return out, count

    def _walk_back(self, unit: int, seed: np.uint64) -> list[int]:
        """Pieces of one occurrence of a long unit, drawn from its end."""
        base, end = int(self.base[unit]), int(self.end[unit])
        low = int(self.last[base]) + 1  # a unit's first node has no incoming edge
        high = int(self.last[end]) + 1
        limit, start, piece = (x[low:high].tolist() for x in (self.limit, self.start, self.piece))
        u = (mixed(seed + np.arange(end - base, dtype=U) * STEP) >> U(64 - SHARE_BITS)).tolist()
        node, drawn = end, []
        while node > base:
            e = bisect_right(limit, (node << (SHARE_BITS + 1)) + u[len(drawn)])
            drawn.append(piece[e])
            node = start[e]
        return drawn


def _walk_forward(start: list[int], end: list[int], weight: list[float]) -> list[float]:
    """``total`` of one unit's nodes from its edges in the order of their ends."""
    total, i, n = [0.0], 0, len(end)
    while i < n:
        node, values = end[i], []
        while i < n and end[i] == node:
            values.append(total[start[i]] + weight[i])
            i += 1
        top = max(values)
        total.append(top + log(sum(exp(v - top) for v in values)))
    return total


class Pieces:
    """The pieces of a SentencePiece model, for sampling and decoding."""

    def __init__(self, path: str, alpha: float) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        text = [model.id_to_piece(i) for i in range(n)]
        odd = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(n)]
        byte = [model.is_byte(i) for i in range(n)]
        score = np.array([model.get_score(i) for i in range(n)])
        self.byte_id = np.full(256, -1)
        for i in range(n):
            if byte[i]:
                self.byte_id[int(text[i][1:-1], 16)] = i
        if (self.byte_id < 0).any():
            raise ValueError("a model with byte fallback is needed")
        plain = [i for i in range(n) if not byte[i] and not odd[i]]
        if any("▁" in text[i].lstrip("▁") for i in plain):
            raise ValueError("pieces that continue past a space are not supported")
        if (score == np.round(score)).all():  # merge ranks: probabilities fall with the rank
            chance = -np.log(1 + np.clip(-score, 0, n))
        else:
            chance = score
        self.weight = alpha * chance
        self.byte_weight = alpha * -np.log(1.0 + n)
        self.bytes = [
            b"" if odd[i] else bytes([int(text[i][1:-1], 16)]) if byte[i] else text[i].replace("▁", " ").encode()
            for i in range(n)
        ]
        self.longest = max(len(text[i]) for i in plain)
        tables: list[dict[int, int]] = [{} for _ in range(self.longest)]
        for i in plain:
            h = np.zeros(1, dtype=U)
            for k, c in enumerate(text[i]):
                h = mixed(h * STEP + U(ord(c)) + U(1))
                tables[k].setdefault(int(h[0]), -1)
            tables[len(text[i]) - 1][int(h[0])] = i
        self.prefixes = []
        for t in tables:
            keys = np.array(sorted(t), dtype=U)
            self.prefixes.append((keys, np.array([t[k] for k in keys.tolist()], dtype=np.int64)))

    def encode(self, keys: list[int | None], texts: list[str | None], seed: int) -> list[np.ndarray]:
        """Sampled piece ids of each text."""
        units = [UNIT.findall(" " + t) if t else [] for t in texts]
        sizes = np.array([len(u) for u in units], dtype=np.int64)
        if not sizes.sum():
            return [np.zeros(0, np.int64) for _ in texts]
        known: dict[str, int] = {}
        number = np.array([known.setdefault(u, len(known)) for x in units for u in x], dtype=np.int64)
        row_seed = mixed(np.array([(k or 0) % (1 << 64) for k in keys], dtype=U) + mixed(np.full(1, seed, dtype=U)))
        row = np.repeat(np.arange(len(texts)), sizes)
        nth = (np.arange(len(number)) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(U)
        ids, count = Lattices(list(known), self).draw(number, mixed(row_seed[row] + nth * U(0xD1B54A32D192ED03)))
        ends = np.cumsum(np.bincount(row, count, len(texts)).astype(np.int64))
        return [self.spelled(x) for x in np.split(ids, ends[:-1])]

    def spelled(self, ids: np.ndarray) -> np.ndarray:
        """Characters without a piece (below 0) as byte pieces."""
        if not (ids < 0).any():
            return ids
        out = [i for x in ids.tolist() for i in ([x] if x >= 0 else self.byte_id[list(chr(-1 - x).encode())].tolist())]
        return np.array(out, dtype=np.int64)

    def decode(self, ids: list[int]) -> str:
        table = self.bytes
        return b"".join([table[i] for i in ids]).decode("utf-8", "replace")[1:]


@lru_cache(maxsize=2)
def pieces(path: str, alpha: float) -> Pieces:
    return Pieces(path, alpha)


def encode(
    docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", alpha: float = 1.0, seed: int = 1
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_chars, n_pieces, pieces, lossless`` (decoding gives the text back).

    ``model`` is the path of a SentencePiece model with byte fallback that
    every executor can open.
    """

    def work(ids: list, texts: list) -> list:
        p = pieces(model, alpha)
        found: list[np.ndarray] = []
        at, size = 0, 0
        for i in range(len(texts) + 1):
            if i == len(texts) or (size and size + len(texts[i] or "") > TEXT_AT_ONCE):
                found += p.encode(ids[at:i], texts[at:i], seed)
                at, size = i, 0
            if i < len(texts):
                size += len(texts[i] or "")
        same = [p.decode(x.tolist()) == (t or "") for x, t in zip(found, texts)]
        cuts = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
        flat = np.concatenate([*found, np.zeros(0, np.int64)]).astype(np.int32)
        listed = pa.ListArray.from_arrays(pa.array(cuts), pa.array(flat))
        return [ids, [len(t or "") for t in texts], [len(x) for x in found], listed, same]

    narrow = docs.select(col(key).cast("long").alias("doc_id"), col(text).cast("string").alias("text"))
    fields = "doc_id long, n_chars long, n_pieces long, pieces array<int>, lossless boolean"
    return map_texts(narrow, work, fields)


def decode(encoded: DataFrame, model: str, key: str = "doc_id", column: str = "pieces") -> DataFrame:
    """Per row of ``encoded``: ``doc_id, text`` from its piece ids (NULL and no pieces: empty text)."""
    def run(batches):
        p = pieces(model, 1.0)
        for b in batches:
            out = [p.decode(x or []) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], names=["doc_id", "text"])

    narrow = encoded.select(col(key).cast("long").alias("doc_id"), col(column).cast("array<int>").alias("pieces"))
    return map_arrow(narrow, run, "doc_id long, text string")
