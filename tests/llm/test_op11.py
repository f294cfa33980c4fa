"""The BPE transducer against the tokenizers library."""

import hashlib
import json
import random
from itertools import product

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry

from lendlens.llm import bpe_transducer as B
from tests.conftest import SMOKE_DIR
from tests.llm.conftest import EDGE_TEXTS

PATH = public_tokenizers.path("word_bpe_49k.json")
# Pieces that meet in odd ways: contractions, marks that compose, white space that only Unicode knows, special strings.
POOL = ["'", "s", "t", "r", "e", "v", "l", "d", "m", "a", "b", "İ", "É", "e\u0301", "\u0301", "\u0327", "-", "!", "😂", "漢", "字", "1", " ",
        "\x85", "\u00a0", "\n", "\x1c", "\x00", "한", "\u1112", "\u1161", "\u11ab", "Σ", "\u212a", "ſ", "ǅ", "the", "ing", "I",
        "<|endoftext|>", "<|startoftext|", "|>"]


@pytest.fixture(scope="module")
def encoder():
    with open(PATH) as f:
        return B.Encoder(f.read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(encoder, text):
    return [i for ids in encoder.encode(text) for i in ids]


def hexed(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return len(ids), hexed(" ".join(map(str, ids))), hexed(library.decode(ids, skip_special_tokens=False))


def test_query_equals_the_library(spark, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMOKE_DIR}/documents.parquet").collect()}
    got = entry.queries()["op11_bpe_codec"](spark, SMOKE_DIR)
    assert got.dtypes == [("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    assert {r["doc_id"]: tuple(r)[1:] for r in got.collect()} == {i: expected(library, t) for i, t in texts.items()}


def test_edge_rows(spark, make_docs, library):
    rows = [(k, t) for k, t in enumerate(EDGE_TEXTS)] + [(None, "It's a TEST"), (3, "x" * 9000 + "'s"), (3, "x" * 9000 + "'s")]
    docs = make_docs(rows).selectExpr("*", "7 AS ids", "8 AS decoded")
    out = B.decode_ids(B.encode_texts(docs, PATH), PATH)
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "ids", "decoded"]
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, ids, library.decode(ids, skip_special_tokens=False)))
    assert sorted(((r["doc_id"], r["ids"], r["decoded"]) for r in out.collect()), key=repr) == sorted(want, key=repr)
    assert B.decode_ids(B.encode_texts(make_docs([]), PATH), PATH).collect() == []
    ids = spark.createDataFrame([(None,), ([],), ([49407, 10 ** 6, 320],)], "ids array<int>")
    assert [r["decoded"] for r in B.decode_ids(ids, PATH).collect()] == ["", "", library.decode([49407, 10 ** 6, 320], skip_special_tokens=False)]


@pytest.mark.parametrize("step, part", [(1, 4), (16, 8), (128, 4096)])
def test_random_texts(encoder, library, monkeypatch, step, part):
    monkeypatch.setattr(B, "STEP", step)
    monkeypatch.setattr(B, "PART_CHARS", part)
    monkeypatch.setattr(B, "REMEMBERED_CHARS", 0)
    draw = random.Random(step)
    for k in range(1500):
        text = "".join(draw.choices(POOL, k=draw.randint(1, 60)))
        if k % 3 == 0:
            text = text.replace(" ", "").replace("\n", "")
        if k % 4 == 0:
            text = "".join(draw.choices(["a", "b", "e", "th", "in", "er", "ð", "😂"], k=400))
        assert ids_of(encoder, text) == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_long_words_need_little_memory(encoder, library):
    draw = random.Random(3)
    for text in ("y" * 60000, "漢字" * 20000, "😂" * 9000, "-" * 5000 + "'s" * 4000, "ha" * 20000, "".join(draw.choices("etaoinshr", k=60000))):
        encoder.most_held = 0
        assert ids_of(encoder, text) == library.encode(text, add_special_tokens=False).ids
        assert encoder.most_held <= encoder.ahead + B.STEP + 32 + 1


def test_lookahead_is_sufficient_and_not_idle():
    """Every prefix's final tokens stay, for all words of small alphabets under random merge lists."""
    draw = random.Random(11)
    seen_late = 0
    for _ in range(60):
        merges, tokens = [], ["a", "b", "c"]
        while len(merges) < 7:
            pair = draw.choice(tokens), draw.choice(tokens)
            if "".join(pair) not in tokens and len("".join(pair)) < 6:
                merges.append(pair)
                tokens.append("".join(pair))
        encoder = B.Encoder.__new__(B.Encoder)
        encoder.suffix = ""
        encoder.learn(merges, {t: k for k, t in enumerate(tokens)})
        ahead = encoder.ahead
        whole = {w: [tokens[i] for i in encoder.merge([tokens.index(c) for c in w])]
                 for n in range(1, 8) for w in map("".join, product("abc", repeat=n))}
        for word, tokens_of in whole.items():
            for n in range(1, len(word)):
                ends = {sum(map(len, whole[word[:n]][:k])) for k in range(1, len(whole[word[:n]]) + 1)}
                final = {e for e in ends if e <= n - ahead}
                kept = {sum(map(len, tokens_of[:k])) for k in range(1, len(tokens_of) + 1)}
                assert final <= kept and {e for e in kept if e <= n - ahead} <= ends
                seen_late += not ends <= kept
    assert seen_late
    assert B.lookahead([("a", "b")]) == 1 and B.lookahead([]) == 0
    assert B.lookahead([("b", "c"), ("a", "b"), ("d", "a")]) == 3  # c decides on b, b on a, a on d
    for bad in ([("a", "b"), ("ab", "c"), ("b", "c"), ("a", "bc")], [("ab", "c"), ("a", "b")]):
        with pytest.raises(ValueError):
            B.lookahead(bad)


def test_text_style_gives_characters_when_complete(encoder, library):
    with open(PATH) as f:
        decoder = B.Decoder(f.read(), "text")
    text = "Héllo wörld, 漢字 it's 12 😂\U0001fae8"
    parts = [decoder.feed([i]) for i in ids_of(encoder, text)] + [decoder.finish()]
    assert "".join(parts) == "héllo wörld , 漢字 it 's 1 2 😂\U0001fae8 "
    assert "" in parts  # a character's first bytes give nothing yet
    cut = [i for i in ids_of(encoder, "\U0001fae8")][:1]
    assert decoder.feed(cut) + decoder.finish() == "\ufffd"


def test_other_vocabularies_are_refused():
    with open(public_tokenizers.path("byte_bpe_50k.json")) as f:
        other = f.read()
    with pytest.raises(ValueError):
        B.Encoder(other)
    with pytest.raises(ValueError):
        B.Decoder(json.dumps(json.loads(other) | {"decoder": {"type": "ByteLevel"}}))
