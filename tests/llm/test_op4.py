import random

from pyspark.sql import functions as F

from lendlens.llm import substring_dedup as S
from lendlens.llm.queries import QUERIES
from tests.conftest import SMOKE_DIR
from tests.llm import brute
from tests.llm.conftest import EDGE_TEXTS
from tests.llm.test_textkernels import thue_morse


def check(spark, docs, rows):
    got = sorted((r["doc_id"] is not None, r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"])
                 for r in S.remove_repeats(docs).collect())
    want = sorted((i is not None, i, *brute.substring_dedup(rows)[n]) for n, (i, _) in enumerate(rows))
    assert got == want


def test_smoke_table_against_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMOKE_DIR}/documents.parquet").collect()]
    want = {i: v for (i, _), v in zip(rows, brute.substring_dedup(rows).values())}
    got = QUERIES["op4_substring_dedup"](spark, SMOKE_DIR).collect()
    assert len(got) == len(rows) and sum(r["n_removed"] for r in got) > 0
    for r in got:
        n, gone, kept = want[r["doc_id"]]
        assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == (n, gone, brute.sha(kept))


def test_edges(spark, make_docs):
    rng = random.Random(1)
    passage = " ".join(f"p{k}" for k in range(40))
    rows = list(enumerate(EDGE_TEXTS)) + [(20 + k, f"{rng.random()} {passage} {rng.random()}") for k in range(30)]
    rows += [(20, f"again {passage}"), (50, passage), (50, passage), (51, "x " * 200), (52, "a " + "b " * 30)]
    rows += [(-4, passage[:60]), (60, " ".join(f"q{k}" for k in range(13))), (61, " ".join(f"q{k}" for k in range(13)))]
    check(spark, make_docs(rows), rows)


def test_null_ids_and_clashing_names(spark, make_docs):
    passage = " ".join(f"p{k}" for k in range(20))
    docs = make_docs([(None, passage), (-1, passage), (3, passage)]).withColumn("n_words", F.lit(7)) \
        .withColumn("bucket", F.lit("x")).withColumn("grp", F.lit(1.5))
    out = S.remove_repeats(docs)
    assert set(out.columns) == {*docs.columns, "n_removed", "kept_text"}
    assert sorted((r["doc_id"] or 0, r["n_words"], r["n_removed"]) for r in out.collect()) == [(-1, 20, 0), (0, 20, 0), (3, 20, 20)]


def test_empty_table(spark, make_docs):
    assert S.remove_repeats(make_docs([])).collect() == []


def test_many_buckets(spark, make_docs, monkeypatch):
    monkeypatch.setattr(S, "WINDOWS_PER_BUCKET", 50)
    monkeypatch.setattr(S, "BYTES_PER_GROUP", 500)
    monkeypatch.setattr(S, "BYTES_PER_BLOCK", 700)
    rng = random.Random(2)
    rows = [(k, " ".join(rng.choice("ab") for _ in range(rng.randrange(60)))) for k in range(120)]
    rows += [(200 + k, rows[k][1] + " tail " + rows[k + 1][1]) for k in range(40)]
    check(spark, make_docs(rows), rows)


def test_structured_words_are_told_apart(spark, make_docs):
    a, b = thue_morse(10)
    around = [f"p{k}" for k in range(12)]
    rows = [(1, " ".join([*around, a])), (2, " ".join([*around, b]))]
    check(spark, make_docs(rows), rows)


def entries_by_key(copies):
    """Windows that each key of the first shuffle gets, for so many documents that share a passage."""
    import numpy as np
    import pyarrow as pa
    passage = " ".join(f"p{k}" for k in range(13))
    texts = pa.array([f"{passage} " + " ".join(f"{k}.{j}" for j in range(20)) for k in range(copies)])
    groups = S._prime_from(1 + copies // 10)
    out = {}
    for batch in S._window_rows(13, 1 + copies // 50, groups)(iter([pa.RecordBatch.from_arrays([pa.array(range(copies)), texts], ["i", "t"])])):
        for key, counts in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist()):
            out[key] = out.get(key, 0) + int(np.frombuffer(counts, dtype="<u4").sum())
    return out


def test_a_common_window_fills_no_key():
    for copies in (1000, 4000):
        sizes = entries_by_key(copies)
        assert max(sizes.values()) <= 4 * 50 * 21  # windows of the documents that one key stands for
        assert sum(sizes.values()) == 21 * copies
