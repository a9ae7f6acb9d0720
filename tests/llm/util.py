"""Shared by the tests of this folder."""

from __future__ import annotations

import random


def frame(spark, rows, ddl, extra=True):
    """A DataFrame with columns that clash with the operators' own names beside the wanted ones."""
    df = spark.createDataFrame(rows, ddl)
    if not extra:
        return df
    taken = {c.lower() for c in df.columns}
    from pyspark.sql import functions as F

    for name in ("row", "node", "key", "h", "n", "vec", "id", "kind", "score", "a.b", "words", "_bucket", "item"):
        if name not in taken:
            df = df.withColumn(name, F.lit("x"))
    return df


def texts(seed: int, n: int, alphabet: str, most: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, most))) for _ in range(n)]


def rows_of(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
