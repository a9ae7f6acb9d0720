import math

import numpy as np
import pytest

from daybook.llm import ann
from tests.llm.util import frame

DDL = "vec_id long, embedding array<float>"


def brute(rows, queries, top):
    good = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in rows]
    out = {}
    for q, x in good:
        if q in queries:
            near = sorted((float(np.sqrt(((v - x) ** 2).sum())), i) for i, v in good if i != q)[:top]
            out[q] = [(i, d) for d, i in near]
    return out


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_exact_where_everything_is_visited(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.integers(-3, 4, 6).astype(float).tolist()) for i in range(300)]  # many ties and equal vectors
    rows = [(i, v) for i, v in rows if any(v)]
    df = frame(spark, rows, DDL)
    queries = df.where("vec_id % 10 = 0")
    got = answers(ann.nearest(df, queries, target_recall=1.0, k=4))
    want = brute(rows, {i for i, _ in rows if i % 10 == 0}, 10)
    assert {q: [i for i, _ in a] for q, a in got.items()} == {q: [i for i, _ in a] for q, a in want.items()}
    assert all(math.isclose(x, y, abs_tol=1e-12) for q in want for (_, x), (_, y) in zip(got[q], want[q]))


def test_hot_vector(spark):
    same = [0.5, -0.5, 1.0, 0.0]
    rows = [(i, same if i % 3 else [float(i), 1.0, 2.0, 3.0]) for i in range(400)]
    df = frame(spark, rows, DDL)
    got = answers(ann.nearest(df, df.where("vec_id % 50 = 1"), top=5, k=4))
    want = brute(rows, {i for i, _ in rows if i % 50 == 1}, 5)
    hot = [q for q in want if q % 3]
    assert {q: got[q] for q in hot} == {q: want[q] for q in hot}  # all at distance 0, smallest ids first


@pytest.mark.parametrize("clustered", [False, True])
def test_recall(spark, clustered):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((3000, 32))
    if clustered:
        x = rng.standard_normal((40, 32))[rng.integers(0, 40, 3000)] * 5 + x
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, DDL)
    got = answers(ann.nearest(df, df.where("vec_id % 60 = 0"), sample=1500))
    want = brute(rows, set(range(0, 3000, 60)), 10)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / (10 * len(want)) >= 0.9
    for q in want:
        true = dict((i, float(np.sqrt(((np.float32(x[i]).astype(float) - np.float32(x[q]).astype(float)) ** 2).sum()))) for i, _ in got[q])
        assert all(math.isclose(d, true[i], rel_tol=1e-12) for i, d in got[q])


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0, 2.0, 3.0]), (8, [0.0, 1.0]), (None, [1.0, 1.0]), (0, [1.0, 0.0])]
    df = frame(spark, rows, DDL)
    got = answers(ann.nearest(df, df))
    assert got == {0: [(8, math.sqrt(2))], 8: [(0, math.sqrt(2)), (0, math.sqrt(2))]}
    none = spark.createDataFrame([], DDL)
    assert ann.nearest(none, none).collect() == []
    bad = df.where("vec_id in (1, 3)")
    assert ann.nearest(bad, bad).collect() == []
    one = df.where("vec_id = 8")
    assert ann.nearest(one, one).collect() == []


def test_cells_are_visited_by_summed_distance():
    rng = np.random.default_rng(5)
    index = ann.MultiIndex(rng.standard_normal((6, 3)), rng.standard_normal((5, 2)))
    q, counts = rng.standard_normal(5), np.ones((6, 5), dtype=int)
    cost = {(i, j): ((q[:3] - index.first[i]) ** 2).sum() + ((q[3:] - index.second[j]) ** 2).sum() for i in range(6) for j in range(5)}
    for n in range(1, 31):
        seen = {(i, j) for i, js in index.visit(q, counts, n).items() for j in js}
        assert seen == set(sorted(cost, key=cost.get)[:n])
