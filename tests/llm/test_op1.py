import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendlens.llm import mixing as M
from lendlens.llm.queries import QUERIES
from tests.conftest import SMOKE_DIR
from tests.llm import brute
from tests.llm.conftest import EDGE_TEXTS


def check(rows, got, slack):
    sizes, taken = defaultdict(int), defaultdict(int)
    for i, t, s in rows:
        sizes[s] += len(brute.words(t))
    want, by_id = brute.source_targets(sizes), defaultdict(list)
    assert len(got) == len(rows)
    for r in got:
        by_id[r["doc_id"]].append(r)
        assert 0 <= r["taken"] <= 2 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
    for i, t, s in rows:
        r = by_id[i].pop()
        assert r["size"] == len(brute.words(t))
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s])
        taken[s] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= slack[s] + 1e-6


def largest(rows):
    out = defaultdict(int)
    for _, t, s in rows:
        out[s] = max(out[s], len(brute.words(t)))
    return out


def test_smoke_table(spark):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in spark.read.parquet(f"{SMOKE_DIR}/documents.parquet").collect()]
    query = QUERIES["op1_mixing_sources"]
    got = query(spark, SMOKE_DIR).collect()
    check(rows, got, largest(rows))
    assert sorted(got) == sorted(query(spark, SMOKE_DIR).repartition(3).collect())


def test_edges_and_tree(spark, make_docs, monkeypatch):
    monkeypatch.setattr(M, "LEAF_ROWS", 10)
    monkeypatch.setattr(M, "FAN_IN", 3)
    rng = random.Random(5)
    rows = [(k, t, "edge") for k, t in enumerate(EDGE_TEXTS)]
    rows += [(100 + k, "w " * rng.randrange(1, 30), rng.choice(["a", "b", "hot", "hot", "hot", None])) for k in range(900)]
    rows += [(2000 + k, "", "empty") for k in range(3)]
    docs = make_docs([(i, t, "en", s) for i, t, s in rows]).withColumn("size", F.lit("x")).withColumn("copies", F.lit(1))
    got = M.mix_sources(docs).collect()
    check(rows, got, largest(rows))
    out = M.mixed(docs)
    assert set(out.columns) == set(docs.columns)
    assert {r["doc_id"]: r["copies"] for r in out.collect()} == {r["doc_id"]: r["copies"] for r in got if r["copies"]}


def test_null_and_repeated_ids(spark, make_docs):
    rows = [(None, "a b", "x"), (None, "a b", "x"), (1, "c", "x"), (1, "c", "x"), (1, "c d e", None), (2, "f", "y")]
    got = M.mix_sources(make_docs([(i, t, "en", s) for i, t, s in rows])).collect()
    assert len(got) == 6
    rows = [(None if k % 3 else k % 5, f"w{k % 40} " * (1 + k % 7), "x" if k % 2 else None) for k in range(300)] + [(1, None, "x"), (None, None, None)]
    docs = make_docs([(i, t, "en", s) for i, t, s in rows])
    plan, out = M.mix_sources(docs).collect(), M.mixed(docs).collect()
    assert len(plan) == len(rows)
    taken = sorted((r["doc_id"] or -1, r["size"], r["copies"]) for r in plan if r["copies"])
    assert sorted((r["doc_id"] or -1, len(brute.words(r["text"])), r["copies"]) for r in out) == taken
    sizes = {s: sum(len(brute.words(t)) for _, t, z in rows if z == s) for s in ("x", None)}
    for s, target in brute.source_targets(sizes).items():
        assert abs(sum(r["copies"] * len(brute.words(r["text"])) for r in out if r["source"] == s) - target) <= 7


def test_empty_table(spark, make_docs):
    assert M.mix_sources(make_docs([])).collect() == []


def test_pivotal_keeps_words_and_expectations():
    size = np.array([5.0, 3, 8, 1, 2, 9, 4, 7])
    p = np.full(8, 0.3)
    total = np.zeros(8)
    for seed in range(3000):
        out = M.pivotal(p, size, np.arange(8), seed)
        assert out @ size == pytest.approx(p @ size) and (~np.isin(out, (0, 1))).sum() <= 1
        total += out
    assert np.allclose(total / 3000, 0.3, atol=0.04)
