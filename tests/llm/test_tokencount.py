import public_tokenizers
import pytest
from tokenizers import Tokenizer

from daybook.llm import tokencount
from tests.llm.util import frame, rows_of, texts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def expected(library, rows, limit):
    out = []
    for i, t in rows:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        out.append((i, len((t or "").encode()), n, n > limit))
    return sorted(out, key=repr)


def test_counts_equal_the_library_on_odd_texts(spark, library):
    odd = "ab é中🎉1²_'s \t\n\r\x1c\x85\xa0​　﻿\0A.!"
    some = texts(1, 400, odd, 40) + ["it's <|endoftext|> we'll<|endoftext|>", "<|endoftext", "a" * 5000, " " * 3000, ""]
    rows = [*enumerate(some), (None, "no id"), (3, None), (3, some[3])]
    df = frame(spark, rows, "doc_id long, text string")
    assert rows_of(tokencount.count_tokens(df, PATH, 16)) == expected(library, rows, 16)


def test_every_code_point_of_the_lower_planes(library):
    counting = tokencount.Counting(PATH)
    points = [chr(c) for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    cases = [f"a{c}1{c}{c} {c}" for c in points]
    want = [len(e.ids) for e in library.encode_batch(cases, add_special_tokens=False)]
    assert [counting.count(c) for c in cases] == want


def test_documents(spark, sf0001, library):
    docs = spark.read.parquet(f"{sf0001}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert rows_of(tokencount.count_tokens(docs, PATH, 1024)) == expected(library, rows, 1024)


def test_empty_table_and_column_names(spark):
    df = spark.createDataFrame([], "`my id` long, `a.text` string")
    assert tokencount.count_tokens(df, PATH, 5, key="my id", text="a.text").collect() == []


def test_the_cache_is_no_cap(monkeypatch):
    monkeypatch.setattr(tokencount, "CACHE_WORDS", 3)
    few, many = tokencount.Counting(PATH), tokencount.Counting(PATH)
    text = " ".join(texts(2, 50, "abcdefg", 9))
    assert few.count(text) == few.count(text) == many.count(text)
    assert len(few.known) <= 3
