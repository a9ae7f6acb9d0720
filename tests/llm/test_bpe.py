import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from daybook.llm import bpe
from tests.llm.util import frame, rows_of

PATH = public_tokenizers.path("byte_bpe_50k.json")
ALPHABETS = [
    "ab é中🎉1²_'s \t\n\r\x1c\x85\xa0​　﻿\0A.!relvtmd", "'re lv", "  \n\ta'", "a", "中文字 ", "'!.,", " ", "<|endoftext|> ab", "éà ",
]
PIECES = ["a", "aaa ", " ", "  ", "'re", "'", "<|endoftext|>", "\n\n", "word", "12", "中"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def odd_texts(seed, n):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        a = rng.choice(ALPHABETS)
        out.append("".join(rng.choice(a) for _ in range(rng.choice([0, 1, 60, 500, 5000, 20_000]))))
        out.append("".join(rng.choice(PIECES) for _ in range(rng.randint(0, 3000))))
    return out


def encoded(codec, texts):
    ids, n = codec.encode(texts)
    return [ids[a:b].tolist() for a, b in zip(n, n[1:])]


def test_equal_to_the_library_on_odd_texts(library):
    codec = bpe.Codec(PATH)
    for seed in range(20):
        texts = odd_texts(seed, 6)
        assert encoded(codec, texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    # Passages shared by many texts come from the cache and meet other neighbours.
    rng = random.Random(7)
    passages = odd_texts(99, 12)
    texts = ["".join(rng.choice(passages) for _ in range(4)) for _ in range(40)]
    assert encoded(codec, texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("plane", range(0, 0x110000, 0x20000))
def test_every_code_point(library, plane):
    codec = bpe.Codec(PATH)
    points = [chr(c) for c in range(plane, plane + 0x20000) if not 0xD800 <= c < 0xE000 and c < 0x110000]
    cases = [f"a{c}1{c}{c} {c}" for c in points]
    assert encoded(codec, cases) == [e.ids for e in library.encode_batch(cases, add_special_tokens=False)]


def test_all_tokens_of_the_vocabulary(library):
    codec = bpe.Codec(PATH)
    words = [t for b in bpe.Vocabulary(PATH).ranks() if (t := b.decode("utf-8", "ignore"))]
    assert len(words) > 49_000
    assert encoded(codec, words) == [e.ids for e in library.encode_batch(words, add_special_tokens=False)]


def test_chunks_are_content_defined():
    rng = random.Random(3)
    passage = "".join(rng.choice("abcdefgh é中") for _ in range(30_000))
    one, two = ({c for c in bpe.chunked([t])[0]} for t in ("x" * 777 + passage, "yy 中" * 91 + passage))
    assert len(one & two) > 0.9 * min(len(one), len(two))
    for texts in (odd_texts(4, 10), ["", "a", "a" * 100_000, "中" * 50_000]):
        for t, chunks in zip(texts, bpe.chunked(texts)):
            assert "".join(chunks) == t
            assert all(len(c.encode()) <= bpe.MOST + 2 * bpe.LEAST for c in chunks)
    # Where a text stands in the buffer does not matter.
    assert bpe.chunked(["z" * 5000, passage])[1] == bpe.chunked([passage])[0]


def test_cuts_do_not_depend_on_blocks(monkeypatch):
    data = np.frombuffer(random.Random(5).randbytes(50_000), dtype=np.uint8)
    whole = bpe.hash_cuts(data).tolist()
    monkeypatch.setattr(bpe, "BLOCK", 999)
    assert bpe.hash_cuts(data).tolist() == whole and len(whole) > 30


def test_shared_chunks_are_encoded_once(monkeypatch):
    codec = bpe.Codec(PATH)
    done = []
    encode = codec.encoded
    monkeypatch.setattr(codec, "encoded", lambda t: done.append(t) or encode(t))
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(3000)]
    text = " ".join(words)
    for _ in range(20):
        codec.encode([text, "a start of its own " + text])
    assert len(done) == len(set(done)) and sum(map(len, done)) < 1.3 * len(text)


def test_the_cache_is_no_cap(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_CHUNKS", 500)
    codec = bpe.Codec(PATH)
    texts = odd_texts(11, 10)
    assert encoded(codec, texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert sum(map(len, codec.old)) + sum(map(len, codec.young)) < 3 * (500 + bpe.MOST + bpe.LEAST)


def test_a_place_without_agreement_is_repaired(library, monkeypatch):
    """Chunks whose places do not meet a token's end are joined until they do, or encoded whole."""
    text = " ".join(odd_texts(12, 5))
    want = library.encode(text, add_special_tokens=False).ids
    for pattern in ("(?!)", "(?<=a)b", r"(?<=\p{L})\P{L}"):
        monkeypatch.setattr(bpe, "SAFE", pattern)
        assert encoded(bpe.Codec(PATH), [text]) == [want]


def test_very_long_texts(library):
    codec = bpe.Codec(PATH)
    texts = ["a" * 400_000, "中" * 100_000, " " * 300_000, "ab " * 200_000, "x" * 70 + "\n" * 200_000]
    assert encoded(codec, texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_decoding_any_ids(library):
    words = bpe.Vocabulary(PATH)
    rng = random.Random(6)
    lists = [[rng.randrange(50_257) for _ in range(rng.randrange(40))] for _ in range(300)] + [[], [50_256]]
    got = words.decode(pa.array(lists, pa.list_(pa.int32()))).to_pylist()
    assert got == [library.decode(x, skip_special_tokens=False) for x in lists]
    odd = pa.array([None, [None, 64], [-5, 10**6, 64], []], pa.list_(pa.int32()))
    assert words.decode(odd).to_pylist() == ["", "a", "a", ""]
    sliced = pa.array([[1, 2], [64], None, [65, 64]], pa.list_(pa.int32())).slice(1)
    assert words.decode(sliced).to_pylist() == ["a", "", "ba"]


def expected(library, rows):
    out = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        assert text == (t or "")
        out.append((i, len(ids), sha(",".join(map(str, ids))), sha(text)))
    return sorted(out, key=repr)


def test_round_trip_of_rows(spark, library):
    rows = [*enumerate(odd_texts(1, 12)), (None, "no id"), (3, None), (3, ""), (5, "twice"), (5, "twice")]
    df = frame(spark, rows, "doc_id long, text string")
    assert rows_of(bpe.round_trip(df, PATH)) == expected(library, rows)


def test_documents(spark, sf0001, library):
    docs = spark.read.parquet(f"{sf0001}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert rows_of(bpe.round_trip(docs.repartition(7), PATH)) == expected(library, rows)


def test_other_columns_and_names(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "`my id` long, `a.text` string")
    ids = bpe.encode(df, PATH, key="my id", text="a.text")
    again = bpe.encode_and_decode(df, PATH, key="my id", text="a.text").collect()
    assert sorted((r.doc_id, r.ids, r.text) for r in again) == [(1, [64, 275], "a b"), (2, [], "")]
    assert {r.doc_id: r.ids for r in ids.collect()} == {1: [64, 275], 2: []}
    kept = ids.withColumn("a.b", F.lit("x")).withColumn("text", F.lit(7)).withColumnRenamed("ids", "my ids")
    back = bpe.decode(kept, PATH, ids="my ids", text="said")
    assert back.columns == ["doc_id", "a.b", "text", "said"]
    assert {tuple(r) for r in back.collect()} == {(1, "x", 7, "a b"), (2, "x", 7, "")}
    assert bpe.round_trip(df.where("false"), PATH, key="my id", text="a.text").collect() == []


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        bpe.Codec(public_tokenizers.path("word_bpe_49k.json"))
