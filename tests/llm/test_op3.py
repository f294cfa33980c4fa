import zlib

import numpy as np
from pyspark.sql import functions as F

from lendlens.llm import toxicity as X
from lendlens.llm.queries import QUERIES
from tests.llm import brute
from tests.llm.conftest import EDGE_TEXTS

SF = "/root/testdata/sf0.1"
LABELS = "doc_id long, toxic int, extra string"


def test_held_out_accuracy(spark):
    got = QUERIES["op3_toxicity"](spark, SF).cache()
    assert got.count() == 10000 and got.where("score BETWEEN 0 AND 1").count() == 10000
    rows = got.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").collect()
    y, s = np.array([r["toxic"] for r in rows]), np.array([r["score"] for r in rows])
    auc = np.mean([(a > b) + (a == b) / 2 for a in s[y == 1] for b in s[y == 0]])
    hit = sum(r["predicted"] and r["toxic"] for r in rows)
    precision, recall = hit / max(1, sum(r["predicted"] for r in rows)), hit / max(1, y.sum())
    print(auc, precision, recall, np.mean((s - y) ** 2))
    assert auc >= 0.85 and precision >= 0.9 and recall >= 0.75


def test_block_max_is_exact():
    rng = np.random.default_rng(1)
    vectors = []
    for _ in range(700):
        t = np.sort(rng.choice(40, rng.integers(1, 6), replace=False))
        w = rng.integers(1, 4, len(t)).astype(float)
        vectors.append((t, w / np.sqrt((w * w).sum())))
    index = X.BlockMaxIndex(vectors, 40)
    dense = np.zeros((700, 40))
    for i, (t, w) in enumerate(vectors):
        dense[i, t] = w
    for i in range(0, 700, 7):
        ids, sims = index.top(*vectors[i], 15, without=i)
        full = dense @ dense[i]
        full[i] = 0
        assert np.allclose(np.sort(full)[::-1][:15], np.pad(sims, (0, 15 - len(sims))))
        assert np.allclose(full[ids], sims) and i not in ids


def tables(spark, make_docs):
    docs = [(k, f"{'you foul thing ' if k % 4 == 0 else ''}some words {k} here and there {k % 7}", "en", "s") for k in range(400)]
    docs += [(1000 + k, t) for k, t in enumerate(EDGE_TEXTS)] + [(None, "you foul thing"), (0, "again foul"), (0, "again foul")]
    labels = [(k, int(k % 4 == 0), "e") for k in range(400)] + [(0, 1, "twice"), (5, None, None), (None, 1, None), (9999, 1, None)]
    return make_docs(docs).withColumn("id", F.lit(1)).withColumn("y", F.lit("y")).withColumn("score", F.lit("z")), \
        spark.createDataFrame(labels, LABELS)


def test_edges_and_evidence(spark, make_docs):
    docs, labels = tables(spark, make_docs)
    out = X.score(docs, X.fit(docs, labels))
    assert set(out.columns) == {*docs.columns, "predicted", "evidence"}
    rows = out.collect()
    assert len(rows) == docs.count()
    for r in rows:
        foul = "foul" in (r["text"] or "")
        assert r["predicted"] == int(foul)
        assert all(e["label"] == int(e["id"] % 4 == 0) and zlib.crc32(str(e["id"]).encode()) % 5 for e in r["evidence"])
        assert not foul or {e["label"] for e in r["evidence"]} == {1}
        assert r["evidence"] or not {"you", "foul", "thing", "some", "words", "here", "and", "there"} & set((r["text"] or "").split())


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    want = brute.toxicity(docs, labels)
    rows = QUERIES["op3_toxicity"](spark, folder).collect()
    assert len(rows) == len(want) and {r["predicted"] for r in rows} == {0, 1}
    for r in rows:
        score, near = want[r["doc_id"]]
        assert abs(r["score"] - score) < 1e-9 and r["predicted"] == int(score >= 0.5)
        # Neighbours of the same similarity may differ in its last digits.
        assert np.allclose([e["similarity"] for e in r["evidence"]], [s for _, s in near])
        sure = {i for i, s in near if s > near[-1][1] + 1e-9}
        assert sure <= {e["id"] for e in r["evidence"]}


def test_a_copy_of_an_example_finds_it(spark, make_docs):
    docs, labels = tables(spark, make_docs)
    odd = "quite unlike what others write, never seen"
    more = make_docs([(2001, odd), (2002, odd), (2003, odd + " " + odd)]).withColumn("id", F.lit(1)).withColumn("y", F.lit("y")).withColumn("score", F.lit("z"))
    labels = labels.union(spark.createDataFrame([(2001, 1, "e")], LABELS))
    assert zlib.crc32(b"2001") % 5
    docs = docs.unionByName(more)
    for r in X.score(docs, X.fit(docs, labels)).where("doc_id > 2000").collect():
        assert r["predicted"] == 1 and r["evidence"][0]["id"] == 2001 and abs(r["evidence"][0]["similarity"] - 1) < 1e-9


def test_bounds_of_the_fit(spark, make_docs, monkeypatch):
    monkeypatch.setattr(X, "EXAMPLES_PER_CLASS", 7)
    docs, labels = tables(spark, make_docs)
    assert len(X.fit(docs, labels).ids) == 13  # seven of each label, one of them without a text
    monkeypatch.setattr(X, "EXAMPLE_BYTES", 1)
    model = X.fit(docs, labels)
    assert len(model.ids) == 2 and sorted(model.votes) == [0, 1]


def test_held_out_labels_are_not_used(spark, make_docs):
    docs, labels = tables(spark, make_docs)
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = ([r["score"] for r in X.score(docs, X.fit(docs, x)).orderBy("doc_id", "text").collect()] for x in (labels, flipped))
    assert a == b


def test_nothing_to_learn(spark, make_docs):
    docs, labels = tables(spark, make_docs)
    for some in (labels.limit(0), labels.where("toxic = 1"), labels.where("toxic = 0")):
        scores = {r["predicted"] for r in X.score(docs, X.fit(docs, some)).collect()}
        assert len(scores) == 1
    assert X.score(make_docs([]), X.fit(make_docs([]), labels)).collect() == []
