import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lendlens.llm import token_counts as T
from lendlens.llm.queries import QUERIES
from tests.conftest import SMOKE_DIR
from tests.llm.conftest import EDGE_TEXTS

PATH = public_tokenizers.path(T.VOCABULARY)
LIBRARY = Tokenizer.from_file(PATH)
COUNTING = T.Counting(open(PATH, encoding="utf-8").read())
ODD = ["a<|endoftext|>b", " <|endoftext|> x<|endoftext|><|endoftext", "\x1c\x1d a", "a\x85b\xa0c  d\n\n e", " ", "it's I'LL don't",
       "２３ ½ Ⅷ", "  x  　 y᠎ z", "é 漢字kana かな 𝒳 😀😀", "\n\n\n x  \t\ty ", "a \nb  c", "x​ y﻿"]


def library(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.one_of(st.sampled_from([" ", "  ", "\n", "\t", "the", " dog", "'s", "'", "12", "é", "<|endoftext|>", "　", "_", "😀"]),
                          st.text(max_size=4)), max_size=20).map("".join))
def test_counts_equal_the_library(text):
    assert COUNTING.count(text) == library(text)


def test_cut_texts(monkeypatch):
    monkeypatch.setattr(T, "CHUNK_CHARS", 7)
    monkeypatch.setattr(T, "REMEMBERED", 3)
    for text in ODD + ["the quick  brown\nfox jumps over\n the lazy dog  \n and then some ", "x" * 60, "a b " * 40]:
        assert COUNTING.count(text) == library(text)


def test_proven_strings_are_single_tokens():
    assert len(COUNTING.whole) > 45_000
    for token in sorted(COUNTING.whole)[::97]:
        assert len(LIBRARY.encode(token, add_special_tokens=False).ids) == 1 or len(LIBRARY.pre_tokenizer.pre_tokenize_str(token)) > 1


def test_smoke_table(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMOKE_DIR}/documents.parquet").collect()}
    got = QUERIES["op8_token_counts"](spark, SMOKE_DIR).collect()
    assert len(got) == len(texts)
    for r in got:
        t = texts[r["doc_id"]]
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len((t or "").encode()), library(t), library(t) > 1024)


def test_edges(spark, make_docs):
    rows = list(enumerate(EDGE_TEXTS + ODD)) + [(None, "a b"), (0, "twice"), (0, "twice")]
    docs = make_docs(rows).withColumn("n_tokens", F.lit("x")).withColumn("extra", F.array(F.lit(1)))
    out = T.count_tokens(docs, PATH)
    assert set(out.columns) == {*docs.columns, "n_bytes", "over_limit"}
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in out.collect()) == sorted((str(i), library(t)) for i, t in rows)
    assert T.count_tokens(make_docs([]), PATH).collect() == []
