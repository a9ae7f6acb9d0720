import pyarrow as pa
import pytest

from daybook.llm import common
from tests.llm.util import frame


def batch(texts):
    return pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], names=["i", "t"])


@pytest.mark.parametrize("texts", [[], [None], [""], ["a" * 30, "b", None, "", "c" * 9, "d" * 2], ["x" * 100], ["é" * 5] * 7])
def test_slices_hold_every_row_in_order(texts):
    parts = list(common.slices([batch(texts), batch(texts)], 1, most=10))
    assert [r for p in parts for r in p.column(1).to_pylist()] == texts * 2
    for p in parts:
        sizes = [len((t or "").encode()) for t in p.column(1).to_pylist()]
        assert sum(sizes) <= 10 or sum(s > 0 for s in sizes) == 1  # a single longer text stands alone


def test_rows_reach_a_task_in_slices_by_bytes(spark, tmp_path):
    """One Arrow batch of many long rows: a filter over whole rows never has more than a slice in hand."""
    from pyspark.sql import functions as F

    text = "z" * 20_000
    docs = spark.range(0, 2000, 1, 1).select(F.col("id").alias("text_id"), F.lit(text).alias("text"), F.lit("x").alias("a.b"))
    most = common.TEXT_PER_CHUNK

    def run(batches):
        for b in batches:
            assert b.num_rows * 20_000 <= most
            yield b

    out = common.map_rows(docs, "text", run)
    assert out.columns == docs.columns and out.count() == 2000


def test_unused_names(spark):
    df = frame(spark, [(1, "t")], "doc_id long, text string").withColumnsRenamed({"row": "_AT"})
    assert common.unused(df, "_at") == "__at" and common.unused(df, "fresh") == "fresh"
