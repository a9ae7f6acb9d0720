import random
from collections import defaultdict

import numpy as np
import pytest

from daybook.llm import minhash
from tests.llm.util import frame


def word_set(text, width):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ").replace("\x0c", " ")
    w = [x for x in w.replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if x]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1)))


def brute(rows, width, percent=80):
    """Component id of every row by comparing all pairs."""
    sets = [word_set(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            n = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
                parent[find(a)] = find(b)
    ids = defaultdict(list)
    for a, (i, _) in enumerate(rows):
        ids[find(a)].append(i)
    out = []
    for a, (i, _) in enumerate(rows):
        own = [x for x in ids[find(a)] if x is not None]
        least = min(own) if own else None
        out.append((i, len(sets[a]), least if sets[a] else i, i is not None and i == (least if sets[a] else i)))
    return sorted(out, key=repr)


def edited(rng, words, share):
    return [rng.choice("abcdefghij") * 3 if rng.random() < share else w for w in words]


def corpus(seed=1, bases=12, copies=8):
    rng = random.Random(seed)
    rows = []
    for _ in range(bases):
        base = [rng.choice("abcdefghijklmnop") + rng.choice("abcdefghijklmnop") for _ in range(rng.randint(1, 120))]
        for _ in range(copies):
            share = rng.choice([0, 0, 0.01, 0.03, 0.05, 0.1, 0.3])
            w = edited(rng, base, share)
            sep = rng.choice([" ", "  ", "\n", "\t", "\x0b", "\x0c\r"])
            rows.append((len(rows) * 3 % 1009, sep.join(w).upper() if rng.random() < 0.2 else sep.join(w)))
    return rows


@pytest.mark.parametrize("width", [2, 5])
def test_components_equal_brute_force(spark, width):
    rows = corpus(width) + [(2000, None), (2001, ""), (2002, " \n"), (2003, "One"), (2004, "oNE"), (2005, "é É"), (2006, "É é"), (2007, "a\xa0b")]
    got = minhash.near_duplicates(frame(spark, rows, "doc_id long, text string"), width=width)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, width)


def test_repeated_and_missing_ids(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "x y z"), (None, "a b c d e f"), (None, "q"), (5, "x y z"), (7, None), (7, None)]
    got = minhash.near_duplicates(frame(spark, rows, "doc_id long, text string"), width=2)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, 2)
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_pairs_that_no_pivot_links(spark):
    """A bucket's pivot may be linked with neither of two linked members: few bands make such buckets common."""
    rows = corpus(9, bases=6, copies=25)
    got = minhash.near_duplicates(frame(spark, rows, "doc_id long, text string"), width=2, bands=60, rows=1)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, 2)


def test_signature_is_unbiased_and_less_variable_than_independent_hashes():
    rng = np.random.default_rng(1)
    m, n = 64, 60
    shares = []
    for _ in range(300):
        x = rng.integers(0, 2**63, 80, dtype=np.uint64)
        a, b = x[:n], x[20:]  # 40 of 80 in common
        sa, sb = minhash.super_minhash([a, b], m)
        shares.append((sa == sb).mean())
    assert abs(np.mean(shares) - 0.5) < 0.01
    assert np.var(shares) < 0.25 / m  # of independent hashes


def test_signature_does_not_depend_on_company():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 2**63, k, dtype=np.uint64)) for k in (1, 2, 5, 50, 700, 3000)]
    together = minhash.super_minhash(sets, 150)
    for s, sig in zip(sets, together):
        assert (minhash.super_minhash([s], 150)[0] == sig).all() and np.isfinite(sig).all()
    assert len(set(np.floor(together[0]).astype(int).tolist())) == 150  # one element: each slot at another step


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(100 + i, 100) for i in range(1, 50)]
    got = {r.node: r.root for r in minhash.components(spark.createDataFrame(path + star, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(50)}}


def test_filter_keeps_one_of_each_group(spark):
    rows = corpus(4) + [(5000, None), (5001, None), (5002, "")]
    df = spark.createDataFrame([(i, t, "s", k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, `a.b` string, n long")
    left = minhash.without_near_duplicates(df)
    assert left.columns == df.columns
    want = sorted(i for i, _, _, kept in brute(rows, 5) if kept)
    assert sorted(r.doc_id for r in left.collect()) == want
    twice = spark.createDataFrame([(1, "a b c d e f g", "s"), (1, "a b c d e f g", "s"), (2, "a b c d e f g", "t"), (None, "z", "u")], "doc_id long, text string, source string")
    assert sorted(map(tuple, minhash.without_near_duplicates(twice).collect()), key=repr) == [(1, "a b c d e f g", "s"), (None, "z", "u")]
    assert minhash.without_near_duplicates(twice.where("false")).collect() == []


def chain():
    """Three texts of which the middle one alone links the outer two (width 5)."""
    words = [f"w{i}" for i in range(60)]
    near = lambda *at: " ".join("x" if i in at else w for i, w in enumerate(words))
    return near(3), near(), near(56)


def test_a_row_without_id_links_its_neighbours(spark):
    left, middle, right = chain()
    assert [k for *_, k in brute([(5, left), (8, right)], 5)] == [True, True]
    for rows in ([(5, left), (None, middle), (8, right)], [(5, left), (None, left + " y")], [(None, left), (None, middle)]):
        got = minhash.near_duplicates(frame(spark, rows, "doc_id long, text string"))
        assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, 5)
        single = minhash.without_near_duplicates(frame(spark, rows, "doc_id long, text string"))
        least = min((r for r in rows), key=lambda r: (r[0] is None, r[0] or 0))
        assert [r.doc_id for r in single.collect()] == [least[0]]


def test_filter_with_repeated_ids(spark):
    a, near, _ = chain()
    rows = [(0, a), (1, near), (1, "quite another text of seven words"), (2, None), (2, None), (None, "far away from all these")]
    df = spark.createDataFrame([(i, t, "s", 1.5) for i, t in rows], "doc_id long, text string, _at string, _times double")
    left = minhash.without_near_duplicates(df)
    assert left.columns == df.columns
    want = [rows[0], rows[2], rows[3], rows[5]]
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=repr) == sorted(want, key=repr)
    both = spark.createDataFrame([(1, a), (1, near)], "doc_id long, text string")
    assert minhash.without_near_duplicates(both).count() == 1
