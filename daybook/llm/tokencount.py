"""Token counts by heap-and-linked-list byte-pair merging.

Each distinct pre-token is merged once per worker: its symbols form a linked
list, a heap holds the adjacent pairs by merge rank (ties: leftmost), and the
lowest pair is popped until none is left. The count is the number of initial
symbols minus the number of merges; no token ids are made. A document's count
sums its pre-tokens' counts, so the work on a document is splitting it and one
dictionary lookup per pre-token.

Defined results: a NULL or empty text has 0 bytes and 0 tokens. Repeated rows
give repeated rows. A special token's string inside a text counts as one
token, as the tokenizer file's library does by default.
"""

from __future__ import annotations

import json
from collections import Counter
from functools import lru_cache
from heapq import heapify, heappop, heappush

import regex
from pyspark.sql import DataFrame

from daybook.llm.common import col, map_texts

CACHE_WORDS = 600_000  # distinct pre-tokens remembered by a worker (a cache, not a cap on results)

# Fixed value: the pre-token pattern of byte-level BPE vocabularies.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_symbols() -> list[str]:
    """Byte -> the visible character that stands for it in a byte-level vocabulary.

    Printable Latin-1 bytes stand for themselves; the others take the code
    points from 256 on, in byte order.
    """
    shown = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


def count_after_merges(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """Symbols left when the lowest-rank adjacent pair is merged until no pair has a rank."""
    n = left = len(symbols)
    heap = [(r, i) for i in range(n - 1) if (r := ranks.get((symbols[i], symbols[i + 1]))) is not None]
    heapify(heap)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    while heap:
        rank, i = heappop(heap)
        a, j = symbols[i], after[i]
        # A stale entry: its left symbol is gone, or its pair has changed since.
        if not a or j >= n or ranks.get((a, symbols[j])) != rank:
            continue
        symbols[i] = whole = a + symbols[j]
        symbols[j] = ""
        left -= 1
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if (r := ranks.get((whole, symbols[k]))) is not None:
                heappush(heap, (r, i))
        p = before[i]
        if p >= 0 and (r := ranks.get((symbols[p], whole))) is not None:
            heappush(heap, (r, p))
    return left


class Counting:
    """A byte-level BPE tokenizer file, for counting only."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["model"]["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["normalizer"]:
            raise ValueError("a byte-level BPE tokenizer without a normalizer is needed")
        merges = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        self.ranks = {(a, b): r for r, (a, b) in enumerate(merges)}
        self.symbols = byte_symbols()
        self.split = regex.compile(SPLIT)
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.known: dict[str, int] = {}

    def word(self, word: str) -> int:
        count = count_after_merges([self.symbols[b] for b in word.encode()], self.ranks)
        if len(self.known) >= CACHE_WORDS:
            self.known.clear()
        self.known[word] = count
        return count

    def count(self, text: str) -> int:
        total, parts = 0, [text]
        if self.special and self.special.search(text):
            parts = self.special.split(text)
            total = len(parts) - 1
        get = self.known.get
        for part in parts:
            for word, times in Counter(self.split.findall(part)).items():
                total += (get(word) or self.word(word)) * times
        return total


@lru_cache(maxsize=2)
def counting(path: str) -> Counting:
    return Counting(path)


def count_tokens(
    docs: DataFrame, tokenizer: str, limit: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_tokens, over_limit`` (more than ``limit`` tokens).

    ``tokenizer`` is the path of a byte-level BPE ``.json`` file that every
    executor can open (an installed package's file, or one shipped with
    ``SparkContext.addFile``).
    """

    def work(ids: list, texts: list) -> list:
        c = counting(tokenizer)
        texts = [t or "" for t in texts]
        n = [c.count(t) for t in texts]
        return [ids, [len(t.encode()) for t in texts], n, [x > limit for x in n]]

    narrow = docs.select(col(key).cast("long").alias("doc_id"), col(text).cast("string").alias("text"))
    return map_texts(narrow, work, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
