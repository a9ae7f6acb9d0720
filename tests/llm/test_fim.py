import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from daybook.llm import fim
from tests.llm.util import frame, texts


def plain_cut(text, key):
    """The contract, code point by code point."""
    h = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    t = text or ""
    n = len(t)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = t[:a], t[a:b], t[b:]
    if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, t
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


ODD = [
    *texts(1, 400, "ab é中🎉<>PSM", 40), "", "a", "é", "🎉", "<P>", "a<S>b", "<M", "<P", "<<P", "S>", "x" * 50_000, "中" * 30_000 + "🎉",
    "a\x00b", "﻿é", "é" * 9, "\n\r\n",
]


def test_rows_equal_the_contract_read_plainly(spark):
    rows = [(random.Random(i).randint(-(10**9), 10**12), t) for i, t in enumerate(ODD)]
    rows += [(None, "no id"), (5, None), (5, "twice"), (5, "twice"), (0, "zero")]
    got = fim.transform(frame(spark, rows, "doc_id long, text string"))
    want = [(i, *plain_cut(t, i)) for i, t in rows]
    key = lambda r: tuple(map(repr, r))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    assert {w[2] for w in want} == {"plain", "psm", "spm"}


def test_digests_and_restored_texts(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(1000, None)]
    got = {r.doc_id: r for r in fim.digests(fim.transform(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for i, t in rows:
        n, form, a, m, out = plain_cut(t, i)
        assert tuple(got[i]) == (i, n, form, a, m, sha(out), sha(t or ""))


@pytest.mark.parametrize("seed", range(6))
def test_unit_ends_rank_and_select(seed):
    rng = random.Random(seed)
    text = "".join(rng.choice("aé中🎉\n") for _ in range(rng.choice([0, 1, 7, 8, 9, 63, 64, 65, 1000])))
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    units = fim.Units(data)
    ends = [len(text[: i + 1].encode()) for i in range(len(text))]
    flat = units.ends.view(np.uint8)
    assert [i + 1 for i in np.flatnonzero(flat).tolist()] == ends and set(flat.tolist()) <= {0, 1}
    if text:
        assert units.select(np.arange(1, len(text) + 1)).tolist() == ends
        assert units.rank(np.arange(len(data) + 1)).tolist() == [sum(e <= b for e in ends) for b in range(len(data) + 1)]


def test_cut_of_a_slice_that_does_not_start_its_buffer():
    whole = pa.array(["xx", "é中", "", "🎉a", "zz"], pa.string())
    h1, h2 = np.array([1, 0, 2]), np.array([2, 0, 1])
    data, start, one, two, end, n, a, b = fim.cut(whole.slice(1, 3), h1, h2)
    raw = data.tobytes()
    parts = [(raw[i:j].decode(), raw[j:k].decode(), raw[k:e].decode()) for i, j, k, e in zip(start, one, two, end)]
    assert parts == [("é", "中", ""), ("", "", ""), ("🎉", "a", "")] and n.tolist() == [2, 0, 2]
    empty = fim.cut(pa.array(["", ""], pa.string()), np.array([3, 4]), np.array([5, 6]))
    assert empty[5].tolist() == [0, 0] and empty[2].tolist() == [0, 0]


def test_rates_and_names(spark):
    df = spark.createDataFrame([(i, f"text {i}") for i in range(300)], "`my id` long, `a.text` string")
    forms = lambda **o: {r.form for r in fim.transform(df, key="my id", text="a.text", **o).select("form").distinct().collect()}
    assert forms(rate=0) == {"plain"} and forms(rate=100, spm_rate=100) == {"spm"} and forms(rate=100, spm_rate=0) == {"psm"}
    assert fim.transform(df.where("false"), key="my id", text="a.text").collect() == []
    one = fim.transform(df, key="my id", text="a.text")
    assert one.exceptAll(fim.transform(df.repartition(5), key="my id", text="a.text")).isEmpty()
    two = fim.transform(df, key="my id", text="a.text", seed="2")
    assert one.select("doc_id", "output").join(two.select(F.col("doc_id"), F.col("output").alias("o")), "doc_id").where("output != o").count() > 100
