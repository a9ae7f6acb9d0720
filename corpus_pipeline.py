"""A corpus pipeline over ``documents``: five stages, each one operator applied to all that its predecessor kept.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it is
written as Parquet (in the shared checkpoint folder) and read again for the
next one. All stages but the last return the columns of ``documents``, also
further ones of any name, and nothing but these. Every stage works on rows: ids may be
NULL or repeat, texts may be NULL, empty or very long, and an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daybook.llm import leaks, minhash, pieces, secrets, toxicity
from daybook.llm.common import kept, table
from daybook.llm.queries import tokenizer_file


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go; it learns from the labels of rows that are not held out.

    Each row is judged by its text alone, whatever its id; NULL and empty texts have the
    model's bias, which keeps them. Repeated rows go or stay together.
    """
    return toxicity.without_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays (five-word shingles, similarity 0.8).

    It is the one with the smallest id; rows without id come last. Rows that repeat an id with
    other words are rows of their own. Texts without words are linked with nothing and stay.
    Rows that repeat both id and text are one row afterwards.
    """
    return minhash.without_near_duplicates(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.

    Each row is judged by its own text, also one without id or with the id of another; NULL and
    empty texts hold nothing and stay, repeated rows go or stay together.
    """
    return leaks.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts, and ``n_chars`` follows; no document goes.

    Rows without a secret, NULL and empty texts stay as they are; repeated rows are masked alike.
    """
    return secrets.redact_secrets(docs)


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled SentencePiece ids of each document, checked to decode to its text.

    One row per row: equal rows get equal pieces, NULL and empty texts none; a row without id draws as id 0.
    """
    return pieces.encode(docs, tokenizer_file("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("secrets", mask_secrets),
    ("sentencepiece", to_pieces),
]

# A trained classifier and sampled segmentations have no SQL form; tests hold
# the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
