"""Sampled suffixes of byte strings (numpy), the entries of the suffix index.

A window is ``length`` bytes. Each window picks one of its ``k``-byte strings,
the one with the smallest hash (leftmost on ties); the picked positions are the
text's sampled suffixes. Equal windows pick the same place, so two equal
windows always share a sampled suffix at the same offset, and only sampled
suffixes (about ``2 / (length - k)`` of all) need to be indexed.

A suffix that starts at ``at`` was picked by the windows that start in
``[lo, hi]``, a contiguous run.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

U = np.uint64
BASE, POSITION_BITS = 0x9E3779B97F4A7C15, 21
POSITION = U((1 << POSITION_BITS) - 1)
PIECE = 1 << (POSITION_BITS - 1)  # bytes of one text handled at once


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(31))) * U(0x7FB5D329728EA185)
    x = (x ^ (x >> U(27))) * U(0x81DADEF4BC2DD44D)
    return x ^ (x >> U(33))


@lru_cache(maxsize=4)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverses mod 2**64 for i < n."""
    up = np.full(n, BASE, dtype=U)
    down = np.full(n, pow(BASE, -1, 1 << 64), dtype=U)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


class Hashes:
    """Hashes of any substring of a byte buffer, from one prefix sum."""

    def __init__(self, data: np.ndarray) -> None:
        n = len(data)
        size = 1 << max(16, n.bit_length())
        up, self.down = powers(size)
        self.sums = np.zeros(n + 1, dtype=U)
        np.cumsum((data.astype(U) + U(1)) * up[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(U))

    def every(self, k: int) -> np.ndarray:
        """Hashes of all strings of k bytes, by start."""
        n = len(self.sums) - k
        return mixed((self.sums[k:] - self.sums[:n]) * self.down[:n] + U(k))


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each ``w`` neighbours: prefix and suffix minima of blocks of ``w``."""
    n = len(x)
    blocks = -(-n // w)
    full = np.full(blocks * w, np.iinfo(x.dtype).max, dtype=x.dtype)
    full[:n] = x
    grid = full.reshape(blocks, w)
    ahead = np.minimum.accumulate(grid, axis=1).reshape(-1)
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[: n - w + 1], ahead[w - 1 : n])


@dataclass
class Suffixes:
    """Sampled suffixes: text number, place, first and last window start, hash of the ``k`` bytes at the place,
    hash of all bytes that its windows cover."""

    row: np.ndarray
    at: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    key: np.ndarray
    extent: np.ndarray


def sample(texts: list[bytes], length: int, k: int) -> Suffixes:
    """Sampled suffixes of all texts; texts are joined up to PIECE bytes, longer ones cut with overlap.

    A window's pick depends on its own bytes alone, so neither the joining nor
    the cutting shows in the result, except that a suffix picked on both
    sides of a cut comes as two entries with adjacent windows.
    """
    parts: list[tuple[list[tuple[int, int, int]], list[bytes]]] = []  # (row, offset in text, bytes), data
    held, data, size = [], [], 0
    for row, text in enumerate(texts):
        for start in range(0, max(len(text) - length + 1, 0), PIECE):
            piece = text[start : start + PIECE + length - 1]
            if size and size + len(piece) > PIECE:
                parts.append((held, data))
                held, data, size = [], [], 0
            held.append((row, start, len(piece)))
            data.append(piece)
            size += len(piece)
    if held:
        parts.append((held, data))
    found = [_sample(h, b"".join(d), length, k) for h, d in parts]
    if not found:
        none = np.zeros(0, dtype=np.int64)
        return Suffixes(none, none, none, none, none.view(U), none.view(U))
    return Suffixes(*map(np.concatenate, zip(*found)))


def _sample(held: list[tuple[int, int, int]], data: bytes, length: int, k: int) -> tuple[np.ndarray, ...]:
    h = Hashes(np.frombuffer(data, dtype=np.uint8))
    keys = h.every(k)
    tagged = (keys & ~POSITION) | np.arange(len(keys), dtype=U)
    pick = (sliding_min(tagged, length - k + 1) & POSITION).astype(np.int64)
    sizes = np.array([n for _, _, n in held])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    # Windows that lie inside one piece.
    inside = np.ones(len(data) + 1, dtype=bool)
    inside[len(pick) :] = False
    for e in ends.tolist():
        inside[e - length + 1 : e] = False
    first = np.flatnonzero(inside)
    pick = pick[first]
    new = np.ones(len(first), dtype=bool)
    new[1:] = (pick[1:] != pick[:-1]) | (first[1:] != first[:-1] + 1)
    begin = np.flatnonzero(new)
    last = np.append(begin[1:], len(first)) - 1
    lo, hi, at = first[begin], first[last], pick[begin]
    piece = np.searchsorted(ends, lo, side="right")
    shift = np.array([s for _, s, _ in held])[piece] - starts[piece]
    rows = np.array([r for r, _, _ in held])[piece]
    return rows, at + shift, lo + shift, hi + shift, keys[at], h.of(lo, hi + length)
