import zlib

from pyspark.sql import functions as F

from lendlens.llm import language_id as L
from lendlens.llm.queries import QUERIES
from tests.llm.conftest import EDGE_TEXTS

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = QUERIES["op6_language_id"](spark, SF)
    rows = got.join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "text"), "doc_id").collect()
    assert len(rows) == 1000 and all(0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {r["doc_id"] for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0}
    right = sum(r["lang_pred"] == r["lang"] for r in held) / len(held)
    sure = [r for r in held if not r["rejected"]]
    print(right, len(sure) / len(held), [(r["lang"], r["lang_pred"], round(r["score"], 3), len(r["text"]), r["text"][:60]) for r in held if r["lang_pred"] != r["lang"]][:10])
    assert right >= 0.97 and sum(r["lang_pred"] == r["lang"] for r in sure) / len(sure) >= 0.985


def test_edges(spark, make_docs):
    rows = [(k, t, None) for k, t in enumerate(EDGE_TEXTS + ["123 !!", "the cat and the dog"])]
    rows += [(100 + k, "the cat and the dog were in the house and the garden " * 3, "en") for k in range(20)]
    rows += [(200 + k, "die Katze und der Hund waren in dem Haus und dem Garten " * 3, "de") for k in range(20)]
    rows += [(None, "the dog", "en"), (100, "the dog", "en"), (300, "123", "xx")]
    docs = make_docs(rows).withColumn("score", F.lit("s")).withColumn("h", F.lit(1))
    dictionaries = L.train_dictionaries(docs)
    assert set(dictionaries) == {"en", "de"}
    out = {(r["doc_id"], r["text"]): r for r in L.identify(docs, dictionaries).collect()}
    for i, t, _ in rows:
        assert (out[i, t]["lang_pred"] == "und") == (t is None or not any(c.isalpha() for c in t))
    assert out[11, "the cat and the dog"]["lang_pred"] == "en"


def test_a_language_of_long_texts_only(spark, make_docs):
    words = "die Katze und der Hund waren nicht in dem alten Haus oder im Garten hinter der Stadt".split()
    long = [" ".join(words[(k * j + j // 7) % len(words)] for j in range(40000)) for k in range(1, 5)]
    rows = [(200 + k, t, "de") for k, t in enumerate(long)] + [(100 + k, "the cat and the dog were in the house and the garden " * 3, "en") for k in range(20)]
    assert all(len(t) > L.DICTIONARY_BYTES for t in long) and any(zlib.crc32(str(200 + k).encode()) % 5 for k in range(4))
    dictionaries = L.train_dictionaries(make_docs(rows))
    assert set(dictionaries) == {"de", "en"} and all(len(d) <= L.DICTIONARY_BYTES for d in dictionaries.values())
    found = L.identify(make_docs([(1, "Der Hund und die Katze waren im Garten"), (2, "the dog and the cat were in the garden")]), dictionaries)
    assert {r["doc_id"]: r["lang_pred"] for r in found.collect()} == {1: "de", 2: "en"}


def test_labels_of_held_out_rows_are_not_used(spark, make_docs):
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert L.train_dictionaries(make_docs([(i, "some text", "en") for i in held])) == {}


def test_empty_table(spark, make_docs):
    assert L.train_dictionaries(make_docs([])) == {}
    assert L.identify(make_docs([]), {}).collect() == []
    assert L.identify(make_docs([(1, "a")]), {}).first()["lang_pred"] == "und"
