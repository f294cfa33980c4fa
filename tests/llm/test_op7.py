import random
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lendlens.llm import chat_format as C
from tests.llm import brute
from tests.llm.conftest import EDGE_TEXTS

SCHEMA = "conv_id long, turn long, role string, text string"
NASTY = list(C.CONTROLS) + ["\\", "\n", "<", "|", "%", "%0A", "user", "é", "𝒳", " ", "\\\\", "im_end|>", "<</s>"]
nasty = st.lists(st.sampled_from(NASTY), max_size=12).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(nasty, nasty), max_size=4))
def test_round_trip_of_any_text(turns):
    whole = "".join(C.render_turn(r, t) for r, t in turns)
    assert [t[:2] for t in C.parse(whole)] == turns
    for role, text, a, b in C.parse(whole):
        assert C.unescape(whole[a:b]) == text


def test_only_conflicts_are_escaped():
    assert C.render_turn("user", "a \\ b < c") == "<|im_start|>user\na \\ b < c\n<|im_end|>\n"
    assert C.render_turn("user", "</s>") == "<|im_start|>user\n\\</s>\n<|im_end|>\n"
    for bad in ("x", "<|im_start|>user", "<|im_start|>u\nx", "<|im_start|>u\na</s>\n<|im_end|>\n"):
        with pytest.raises(C.GrammarError):
            C.parse(bad)


def want(rows):
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        talks[conv].append((turn is not None, turn, role or "", text or ""))
    out = {}
    for conv, turns in talks.items():
        turns.sort(key=lambda t: (t[0], t[1] or 0, t[2], t[3]))
        loss = "".join(t[3] for t in turns if t[2] == "assistant")
        out[conv] = (len(turns), brute.sha("".join(f"{t[2]}\n{t[3]}\n" for t in turns)), len(loss), brute.sha(loss))
    return out


def test_tables(spark):
    rng = random.Random(7)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "a\n<b"]), rng.choice(EDGE_TEXTS + NASTY))
            for c in [None, 1, 2, 3, 99] for t in [0, 1, 1, 2, 3, None]]
    rows += [(5, t, "assistant" if t % 2 else "user", f"turn {t} </s>") for t in range(3000)]
    rng.shuffle(rows)
    talks = spark.createDataFrame(rows, SCHEMA).withColumn("piece", F.lit(1)).withColumn("conv", F.lit("x"))
    pieces = C.format_chats(talks).cache()
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in C.read_back(pieces).collect()}
    assert got == want(rows)
    text = defaultdict(str)
    for r in pieces.orderBy("conv_id", "nth").collect():
        assert r["char_start"] == len(text[r["conv_id"]])
        text[r["conv_id"]] += r["piece"]
    assert {r["conv_id"]: r["formatted_chars"] for r in C.read_back(pieces).collect()} == {c: len(t) for c, t in text.items()}
    for r in pieces.where("loss_start IS NOT NULL AND conv_id = 5").collect():
        assert C.unescape(text[5][r["loss_start"]:r["loss_end"]]) == f"turn {r['nth']} </s>"


def test_empty_table(spark):
    assert C.read_back(C.format_chats(spark.createDataFrame([], SCHEMA))).collect() == []
