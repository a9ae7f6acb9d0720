import math
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece

from daybook.llm import pieces
from tests.llm.util import frame, rows_of

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = [*"ab é▁中🎉\n\t\0 ", "  ", "▁▁", "the ", "Ł", "​", "   "]


def odd_texts(seed, n, most=30):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, most))) for _ in range(n)]


@pytest.fixture(scope="module")
def model():
    return pieces.Pieces(MODEL, 1.0)


def test_lossless_and_independent_of_batches(spark):
    rows = [*enumerate(odd_texts(1, 400)), (500, "a" * 20_000), (501, " " * 2000), (502, None), (503, ""), (None, "x y"), (3, "again"), (3, "again")]
    df = frame(spark, rows, "doc_id long, text string")
    got = pieces.encode(df, MODEL).collect()
    assert len(got) == len(rows) and all(r.lossless and len(r.pieces) == r.n_pieces for r in got)
    assert rows_of(pieces.encode(df.repartition(7), MODEL)) == sorted(map(tuple, got), key=repr)
    again = pieces.decode(spark.createDataFrame(got), MODEL).collect()
    assert sorted((r.doc_id or -1, r.text) for r in again) == sorted((i or -1, t or "") for i, t in rows)
    assert pieces.encode(df.where("false"), MODEL).collect() == []


def test_seeds_differ(model):
    text = ["the quick brown foxes jump over the lazy dogs " * 5]
    a, b, c = (model.encode([k], text, s)[0].tolist() for k, s in ((1, 1), (2, 1), (1, 2)))
    assert a != b and a != c and a == model.encode([1], text, 1)[0].tolist()


def test_pieces_are_the_models_and_its_library_decodes_them(model):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for t in ("hello world", "a  b", "naïve café 中文", "line\nbreak\ttab"):
        ids = model.encode([1], [t], 1)[0].tolist()
        assert library.decode(ids) == t
        assert "".join(library.id_to_piece(i) for i in ids if not library.is_byte(i)).startswith("▁")


@pytest.mark.parametrize("alpha", [1.0, 0.3])
def test_sampling_follows_the_lattice(alpha):
    model = pieces.Pieces(MODEL, alpha)
    known = {b.decode().replace(" ", "▁"): i for i, b in enumerate(model.bytes) if i >= 259 and b}

    def paths(s):
        if not s:
            yield ()
        for n in range(1, len(s) + 1):
            if s[:n] in known:
                for rest in paths(s[n:]):
                    yield (known[s[:n]], *rest)

    weight = {p: math.exp(sum(model.weight[i] for i in p)) for p in paths("▁the▁cat")}
    total, n = sum(weight.values()), 30_000
    count = Counter(tuple(x.tolist()) for x in model.encode(list(range(n)), ["the cat"] * n, 1))
    assert set(count) <= set(weight)
    for p, w in weight.items():
        want = w / total
        assert abs(count[p] / n - want) < 5 * math.sqrt(want * (1 - want) / n) + 1e-4


def plain_draw(model, unit, seed):
    """Forward filtering and backward sampling of one unit, written plainly."""
    known = {}
    for i, b in enumerate(model.bytes):
        if i >= 259 and b:
            known[b.decode().replace(" ", "\u2581")] = i
    s = unit.replace("\u2581", "\0\0").replace(" ", "\u2581")
    edges = [[] for _ in range(len(s) + 1)]
    for end in range(1, len(s) + 1):
        for start in range(max(0, end - model.longest), end):
            i = known.get(s[start:end])
            if i is not None:
                edges[end].append((start, i, float(model.weight[i])))
        if s[end - 1] not in known:
            edges[end].append((end - 1, -1 - ord(s[end - 1]), model.byte_weight * len(s[end - 1].encode())))
    total = [0.0]
    for e in edges[1:]:
        values = [total[a] + w for a, _, w in e]
        top = max(values)
        total.append(top + math.log(sum(math.exp(v - top) for v in values)))
    return edges, total


@pytest.mark.parametrize("long", [0, 3, 10**9])
def test_long_units_are_drawn_as_short_ones(model, monkeypatch, long):
    """Both ways of walking a lattice give the same totals; the share of each draw is the lattice's."""
    units = [" theaterthere", " abababab", "xyz", " a", " naïvecaféécole"]
    monkeypatch.setattr(pieces, "LONG", long)
    lattices = pieces.Lattices(units, model)
    for k, unit in enumerate(units):
        edges, total = plain_draw(model, unit, 1)
        for at, e in enumerate(edges[1:], 1):
            node = lattices.base[k] + at
            lo = lattices.last[node - 1] + 1 if at > 1 else lattices.last[lattices.base[k]] + 1
            upto = (lattices.limit[lo : lattices.last[node] + 1] - (int(node) << 33)) / 2.0**32
            shares = sorted(upto.tolist())
            want, run = [], 0.0
            got = {int(p): None for p in lattices.piece[lo : lattices.last[node] + 1]}
            weights = {i: math.exp(total[a] + w - total[at]) for a, i, w in e}
            assert {abs(x) if x < 0 else x for x in got} == {abs(x) if x < 0 else x for x in weights}
            before = 0.0
            for p, u in zip(lattices.piece[lo : lattices.last[node] + 1].tolist(), upto.tolist()):
                assert abs((u - before) - weights[p]) < 1e-6
                before = u
            assert shares[-1] == 1.0


def test_draws_do_not_depend_on_the_company(model):
    rng = random.Random(4)
    texts_ = [t for t in odd_texts(9, 60, 200) if t] + ["中文" * 700, "a" * 1000, "the cat " * 50]
    alone = {i: model.encode([i], [t], 1)[0].tolist() for i, t in enumerate(texts_)}
    for _ in range(5):
        order = rng.sample(range(len(texts_)), len(texts_))
        together = model.encode(order, [texts_[i] for i in order], 1)
        assert {i: x.tolist() for i, x in zip(order, together)} == alone


def test_texts_without_spaces_take_linear_time(model):
    import time

    rng = random.Random(2)
    point = [chr(c) for c in range(0x4E00, 0x4E00 + 3000)]
    for t in ("".join(rng.choice(point) for _ in range(200_000)), "ab" * 100_000):
        began = time.perf_counter()
        ids = model.encode([1], [t], 1)[0]
        assert time.perf_counter() - began < 12 and model.decode(ids.tolist()) == t  # 20 s before, one numpy step a character
