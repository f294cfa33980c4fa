"""Importance resampling against plain Python."""

import __spark_entry__ as entry

from lendlens.llm import importance_resampling as R
from tests.conftest import SMOKE_DIR
from tests.llm import brute
from tests.llm.conftest import EDGE_TEXTS

FIELDS = ("doc_id", "n_features", "weight", "score", "rank")


def plain(df):
    return sorted((tuple(r[f] for f in FIELDS) for r in df.collect()), key=repr)


def test_query_equals_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMOKE_DIR}/documents.parquet").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{SMOKE_DIR}/benchmark.parquet").collect()]
    out = entry.queries()["op13_importance_resampling"](spark, SMOKE_DIR)
    assert out.dtypes == [(f, "bigint") for f in FIELDS]
    assert plain(out) == sorted(brute.resampling(docs, target), key=repr)


def test_edge_rows(spark, make_docs):
    rows = [(k, t) for k, t in enumerate(EDGE_TEXTS)] + [(None, "A b " * 30), (None, "A b " * 30), (3, "a B " * 30), (3, "a B " * 30),
            (90, "\x00x\x7fÀ-à_É 9 漢字 " * 12), (91, "Σς ǅ İ ß ﬀ " * 9)]
    target = spark.createDataFrame([("a b a b",), (None,), ("",)], "text string")
    docs = make_docs(rows).selectExpr("*", "'x' AS rank", "1 AS weight", "2 AS buckets")
    out = R.resample(docs, target, share=(1, 2))
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "n_words", "n_features", "weight", "score", "rank"]
    got, want = plain(out), sorted(brute.resampling(rows, ["a b a b"], share=(1, 2)), key=repr)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    # Of rows that are equal in all columns either may have the better rank.
    assert sorted((r[0], r[3], r[4]) for r in got if r[4]) == sorted((r[0], r[3], r[4]) for r in want if r[4])


def test_empty_tables(spark, make_docs):
    empty = spark.createDataFrame([], "text string")
    assert R.resample(make_docs([]), empty).collect() == []
    rows = [(1, "a b c"), (2, "word " * 40)]
    assert plain(R.resample(make_docs(rows), empty, share=(1, 1))) == sorted(brute.resampling(rows, [], share=(1, 1)), key=repr)


def test_parts_of_a_long_text(monkeypatch):
    text = "One two, THREE four\x00five É漢字 six; " * 50 + "y" * 500 + " end of it"
    whole = R.features(text, R.splitter())
    for size in (1, 7, 40, 300):
        monkeypatch.setattr(R, "CHUNK_BYTES", size)
        n, hashes = R.features(text, R.splitter())
        assert n == whole[0] and sorted(hashes) == sorted(whole[1])


def test_ranks_run_on_over_partitions(spark):
    rows = spark.range(5000).selectExpr("id AS doc_id", "CAST(20 + id % 3 - id % 2 AS BIGINT) AS n_words", "id % 7 AS score")
    got = R.ranked(rows, share=(1, 3)).collect()
    order = sorted((r for r in got if r["n_words"] >= 20), key=lambda r: (-r["score"], r["doc_id"]))
    drawn = order[:len(order) // 3]
    assert [r["rank"] for r in drawn] == list(range(1, len(drawn) + 1))
    assert sum(r["rank"] is not None for r in got) == len(drawn) and len(got) == 5000
