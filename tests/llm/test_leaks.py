import random
import re
from collections import Counter

from pyspark.sql import functions as F

from daybook.llm import leaks
from tests.llm.util import frame


def words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def brute(docs, items, width=5, percent=80):
    out = set()
    for doc, text in docs:
        w = words(text)
        for item, said in items:
            v = words(said)
            k = min(width, len(v))
            if not v or len(w) < k:
                continue
            have = Counter(tuple(v[i : i + k]) for i in range(len(v) - k + 1))
            all_ = [tuple(w[i : i + k]) for i in range(len(w) - k + 1)]
            m = len(v) - k + 1
            size = min(m, len(all_))
            best = None
            for t in range(len(all_) - size + 1):
                both = sum((Counter(all_[t : t + size]) & have).values())
                if (all_[t] in have or t == len(all_) - size) and (best is None or both > best[0]):
                    best = (both, t)
            both, t = best
            if 100 * both >= percent * (size + m - both):
                out.add((doc, item, both / (size + m - both), t))
    return sorted(out, key=repr)


def found(spark, docs, items, **options):
    got = leaks.leaks(frame(spark, docs, "doc_id long, text string"), frame(spark, items, "item_id long, text string"), **options)
    return sorted({(r.doc_id, r.item_id, r.similarity, r.window_start) for r in got.collect()}, key=repr)


def corpus(seed):
    rng = random.Random(seed)
    lexicon = [a + b for a in "abcdefgh" for b in "ijklmnop"]
    items = [(i, " ".join(rng.choice(lexicon) for _ in range(rng.choice([1, 2, 3, 4, 5, 6, 12, 40, 60])))) for i in range(30)]
    items += [(40, "ab ab ab ab ab ab ab ab ab"), (41, ""), (42, None), (43, items[7][1]), (7, items[7][1])]
    docs = []
    for i in range(120):
        w = [rng.choice(lexicon) for _ in range(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 2)):
            said = words(rng.choice(items)[1])
            if said:
                cut = said[rng.randint(0, max(0, len(said) // 12)) :]
                if rng.random() < 0.5:
                    cut[rng.randrange(len(cut))] = "zz"
                w += cut + [rng.choice(lexicon) for _ in range(rng.randint(0, 20))]
        docs.append((i, rng.choice([" ", ", ", "\n", "-"]).join(w).upper() if i % 7 == 0 else " ".join(w)))
    return docs + [(200, None), (201, ""), (5, docs[5][1]), (None, items[10][1]), (202, "ab " * 30)], items


def test_equal_to_brute_force(spark):
    for seed in (1, 2):
        docs, items = corpus(seed)
        want = brute(docs, items)
        assert len(want) > 40 and any(s < 1 for _, _, s, _ in want)
        assert found(spark, docs, items) == want
    assert found(spark, docs, items, broadcast_rows=0) == want  # shuffled instead of broadcast


def test_nothing_to_find(spark):
    docs, items = corpus(3)
    assert found(spark, [], items) == found(spark, docs, []) == found(spark, docs, [(1, None), (2, " .")]) == []


def test_filter(spark):
    docs, items = corpus(1)
    df = spark.createDataFrame([(i, t, "s") for i, t in docs], "doc_id long, text string, `a.b` string")
    left = leaks.without_leaks(df, spark.createDataFrame(items, "item_id long, text string"))
    bad = {d for d, _, _, _ in brute(docs, items)}
    assert left.columns == df.columns
    assert sorted((r.doc_id for r in left.collect()), key=str) == sorted((i for i, _ in docs if i not in bad), key=str)


def test_multi_index_misses_nothing_within_the_radius(spark):
    rng = random.Random(4)
    rows = []
    for _ in range(400):
        a, flips = rng.getrandbits(64), rng.sample(range(64), rng.randint(0, 31))
        b = a
        for f in flips:
            b ^= 1 << f
        rows.append(tuple(x - (1 << 64) if x >> 63 else x for x in (a, b)) + (len(flips),))
    df = spark.createDataFrame(rows, "a long, b long, d int")
    met = F.arrays_overlap(leaks.block_codes(F.col("a"), 0), leaks.block_codes(F.col("b"), leaks.BLOCK_RADIUS))
    got = df.select("d", met.alias("met"), F.bit_count(F.col("a").bitwiseXOR(F.col("b"))).alias("bits")).collect()
    assert all(r.met and r.bits == r.d for r in got)


def test_simhash_is_the_majority_of_bits(spark):
    rows = [([1, 3, 3],), ([-1, 0, 5, 7],), ([-(1 << 63)],)]
    got = [r.s for r in spark.createDataFrame(rows, "x array<long>").select(leaks.simhash(F.col("x")).alias("s")).collect()]
    assert got == [3, 5, -(1 << 63)]


def test_plan_has_no_python(spark):
    docs, items = corpus(1)
    df = leaks.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    plan = df._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
