"""Toxicity by non-negative positive-unlabelled learning.

A linear model over the distinct words of a text (hashed) is trained in numpy
from confirmed toxic texts (P) and texts of unknown class (U) with the risk

    prior * E_P[l(g)] + max(0, E_U[l(-g)] - prior * E_P[l(-g)]),

``l`` the logistic loss, ``prior`` the share of toxic texts. Where the second
term falls below zero the model has begun to call hidden toxic texts in U
clean for certain, and the step goes the other way. A soft threshold after
each step keeps words without evidence at weight 0, so length alone moves no
score.

Training rows are a bounded sample (``most_positive``, ``most_unlabelled``
rows by the smallest hash of the id); the prior is counted over all labelled
rows; scoring covers every whole text. Held-out rows (``crc32(id) % 4 == 2``)
give neither labels nor text to the training.

Defined results: NULL and empty texts get the model's bias alone; a row
without id is not held out; rows with NULL labels are unlabelled; an id that is
labelled more than once counts as toxic if any of its labels says so; without
any confirmed toxic row every score is the prior (0 if nothing is labelled).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import col, map_rows, map_texts

BITS = 18
WORD = re.compile(r"[^\W\d_]+")


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def word_ids(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and hashed word numbers of all words, in order."""
    words = [WORD.findall((t or "").lower()) for t in texts]
    rows = np.repeat(np.arange(len(words)), [len(w) for w in words])
    flat = np.array([x for w in words for x in w], dtype=object)
    if not len(flat):
        return rows, np.zeros(0, np.int64)
    hashed = pd.util.hash_array(flat, categorize=False)
    return rows, (hashed >> np.uint64(64 - BITS)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    """Weights of the words that carry evidence; all others weigh 0."""

    words: np.ndarray
    weights: np.ndarray
    bias: float

    def table(self) -> np.ndarray:
        full = np.zeros(1 << BITS)
        full[self.words] = self.weights
        return full

    def scores(self, texts: list[str | None], table: np.ndarray | None = None) -> np.ndarray:
        table = self.table() if table is None else table
        rows, ids = word_ids(texts)
        told = table[ids] != 0
        pairs = np.unique(rows[told] * (1 << BITS) + ids[told])
        g = self.bias + np.bincount(pairs >> BITS, table[pairs & ((1 << BITS) - 1)], len(texts))
        return 1 / (1 + np.exp(-g))


def fit_nnpu(
    positive: list[np.ndarray],
    unlabelled: list[np.ndarray],
    prior: float,
    epochs: int = 300,
    rate: float = 0.05,
    shrink: float = 1e-3,
    least_rows: int = 3,
) -> Model:
    """Proximal gradient descent (Adam-scaled) on the non-negative PU risk. Rows are arrays of distinct word ids."""
    none = Model(np.zeros(0, np.int64), np.zeros(0), float(np.log((prior + 1e-6) / (1 - prior + 1e-6))))
    if not positive or not unlabelled:
        return none
    n_p, n_u = len(positive), len(unlabelled)
    row = np.repeat(np.arange(n_p + n_u), [len(x) for x in (*positive, *unlabelled)])
    word = np.concatenate([*positive, *unlabelled]).astype(np.int64)
    in_p = np.bincount(word[row < n_p], minlength=1 << BITS)
    words = np.flatnonzero(in_p >= least_rows)  # a word unseen in P can't speak for toxicity
    if not len(words):
        return none
    place = np.full(1 << BITS, -1)
    place[words] = np.arange(len(words))
    use = place[word] >= 0
    row, word = row[use], place[word[use]]
    w, b = np.zeros(len(words)), none.bias
    m, v = np.zeros(len(words) + 1), np.zeros(len(words) + 1)
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -50, 50)))
    for t in range(1, epochs + 1):
        g = b + np.bincount(row, w[word], n_p + n_u)
        gp, gu = g[:n_p], g[n_p:]
        negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        up, uu = -prior * sig(-gp) / n_p, np.zeros(n_u)
        if negative >= 0:
            up = up - prior * sig(gp) / n_p
            uu = sig(gu) / n_u
        else:  # step back from the overfit part of the risk
            up = prior * sig(gp) / n_p
            uu = -sig(gu) / n_u
        d = np.concatenate([up, uu])
        grad = np.append(np.bincount(word, d[row], len(words)), d.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-4)
        w = w - step[:-1]
        w = np.sign(w) * np.maximum(0, np.abs(w) - rate * shrink / 1e-2)
        b = b - step[-1]
    told = w != 0
    return Model(words[told], w[told], float(b))


def sampled_words(docs: DataFrame, ids: DataFrame, most: int) -> list[np.ndarray]:
    """Distinct word ids of at most ``most`` rows of ``docs`` whose id has the smallest hashes among ``ids``."""
    chosen = ids.dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = docs.join(F.broadcast(chosen), "doc_id", "left_semi").select("doc_id", "text")

    def work(_: list, texts: list) -> list:
        at, words = word_ids(texts)
        cuts = np.searchsorted(at, np.arange(1, len(texts)))
        return [[np.unique(x).tolist() for x in np.split(words, cuts)]]

    found = map_texts(rows, work, "words array<int>").limit(most).collect()
    return [np.array(r.words, dtype=np.int64) for r in found]


def train(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    toxic: str = "toxic",
    most_positive: int = 4000,
    most_unlabelled: int = 8000,
) -> Model:
    docs = docs.select(col(key).alias("doc_id"), col(text).cast("string").alias("text"))
    docs = docs.where(~held_out(F.col("doc_id")))
    labelled = (
        labels.select(col(key).alias("doc_id"), col(toxic).cast("int").alias("toxic"))
        .where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    share = labelled.agg(F.avg("toxic").alias("p")).first().p or 0.0
    positive = sampled_words(docs, labelled.where("toxic = 1").select("doc_id"), most_positive)
    unlabelled = sampled_words(docs, docs.where("doc_id is not null").select("doc_id"), most_unlabelled)
    return fit_nnpu(positive, unlabelled, float(share))


def score(
    docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", threshold: float = 0.3
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, held_out, score, predicted``. Only the text makes the score."""

    def work(ids: list, texts: list) -> list:
        s = model.scores(texts)
        return [ids, s.tolist(), (s >= threshold).astype(int).tolist()]

    narrow = docs.select(col(key).cast("long").alias("doc_id"), col(text).cast("string").alias("text"))
    scored = map_texts(narrow, work, "doc_id long, score double, predicted int")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def without_toxic(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """``docs`` without the rows whose text scores ``threshold`` or more; columns and other rows stay."""

    def run(batches):
        table = model.table()
        for b in batches:
            yield b.filter(pa.array(model.scores(b.column(0).to_pylist(), table) < threshold))

    return map_rows(docs, text, run)
