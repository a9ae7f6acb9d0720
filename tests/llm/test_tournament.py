import hashlib
import random

import numpy as np
import pytest

from daybook.llm import tournament
from tests.llm.util import frame

INF, NAN = float("inf"), float("nan")
DDL = "vec_id long, embedding array<float>"


def brute(rows, size, k, rounds, scale=256):
    """Whole-number k-means read from the contract; rows of ``(id, vector)``."""
    from fractions import Fraction
    from math import floor, isfinite

    kept = []
    for i, v in rows:
        if v is not None and len(v) == size and all(x is not None and isfinite(x) for x in v):
            kept.append((i, [floor(Fraction(scale) * Fraction(x)) for x in v]))
    if not kept:
        return []
    order = lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1])
    centroids = [v for _, v in sorted(kept, key=order)[:k]]
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda v: min(range(len(centroids)), key=lambda c: (square(v, centroids[c]), c))
    for _ in range(rounds):
        told = [nearest(v) for _, v in kept]
        for c in range(len(centroids)):
            mine = [v for t, (_, v) in zip(told, kept) if t == c]
            if mine:
                centroids[c] = [sum(x) // len(mine) for x in zip(*mine)]
    told = [nearest(v) for _, v in kept]
    d = [square(v, centroids[t]) for t, (_, v) in zip(told, kept)]
    sums = {c: sum(x for x, t in zip(d, told) if t == c) for c in told}
    digest = lambda c: hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()
    fits = lambda x: x if x < 2**63 else None
    return [(i, t, fits(x), fits(sums[t]), fits(sum(d)), digest(t)) for (i, _), t, x in zip(kept, told, d)]


def result(df, **options):
    return sorted(map(tuple, tournament.cluster(df, **options).drop("centroid").collect()), key=repr)


def vectors(seed, n, size, spread=1.0):
    rng = random.Random(seed)
    return [(rng.randint(0, 10**6), [float(np.float32(rng.uniform(-spread, spread))) for _ in range(size)]) for _ in range(n)]


def test_equal_to_brute_force(spark):
    rows = vectors(1, 300, 64)
    assert result(frame(spark, rows, DDL)) == sorted(brute(rows, 64, 40, 5), key=repr)


def test_ties_repeated_rows_and_what_takes_no_part(spark):
    rng = random.Random(2)
    rows = [(i % 50, [float(rng.randint(-1, 1)) / 256 for _ in range(4)]) for i in range(240)]  # few distinct vectors
    rows += [rows[0]] * 30 + [(None, [0.0, 0.0, 0.0, -0.0]), (None, [1.0, 0.0, 0.0, 0.0]), (7, None), (8, []), (9, [1.0] * 3), (9, [1.0] * 5)]
    rows += [(10, [1.0, None, 0.0, 0.0]), (11, [NAN, 0.0, 0.0, 0.0]), (12, [0.0, 0.0, INF, 0.0]), (13, [-INF] * 4)]
    want = sorted(brute(rows, 4, 12, 4), key=repr)
    assert result(frame(spark, rows, DDL), size=4, k=12, rounds=4) == want and len(want) == 272


def test_fewer_vectors_than_centroids_one_and_none(spark):
    rows = vectors(3, 7, 5)
    assert result(frame(spark, rows, DDL), size=5) == sorted(brute(rows, 5, 40, 5), key=repr)
    assert result(frame(spark, rows[:1], DDL), size=5)[0][1:5] == (0, 0, 0, 0)
    none = tournament.cluster(spark.createDataFrame([], DDL))
    assert none.collect() == [] and none.columns[:5] == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia"]


def test_large_components_are_exact(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice([-1, 1]) * rng.uniform(1, 2) * 2.0 ** rng.choice([0, 20, 30, 50]) for _ in range(3)]) for i in range(60)]
    ddl = "vec_id long, embedding array<double>"
    assert result(frame(spark, rows, ddl), size=3, k=6, rounds=3) == sorted(brute(rows, 3, 6, 3), key=repr)
    with pytest.raises(Exception, match="2\\*\\*60"):
        result(spark.createDataFrame([(1, [2.0**60, 0.0, 0.0])], ddl), size=3)


@pytest.mark.parametrize("kind", [np.int64, object])
def test_a_tournament_finds_the_nearest(kind):
    rng = np.random.default_rng(5)
    for size, k in ((1, 9), (3, 40), (64, 40)):
        c = rng.integers(-3, 4, (k, size))
        c[k // 2] = c[0]  # equal centroids
        x = rng.integers(-3, 4, (500, size))
        d = ((x[:, None, :] - c[None, :, :]) ** 2).sum(2)
        game = tournament.Bisectors(c.tolist(), kind)
        champion = game.nearest(x.astype(kind))
        assert (champion == d.argmin(1)).all()  # argmin takes the first of equals
        assert game.distances(x.astype(kind), champion).tolist() == d.min(1).tolist()


def test_the_limit_of_64_bits():
    for size in (1, 3, 64, 1000):
        m = tournament.small_enough(size)
        c = [[m] * size, [-m] * size]
        worst = abs(sum(2 * (-2 * m) * m for _ in range(size))) + size * m * m
        assert worst < 2**63
        game = tournament.Bisectors(c, np.int64)
        assert game.nearest(np.array([[m] * size, [-m] * size])).tolist() == [0, 1]


def test_partitions_do_not_matter(spark):
    df = spark.createDataFrame(vectors(6, 200, 8), DDL)
    assert result(df.repartition(1), size=8) == result(df.repartition(9), size=8)
