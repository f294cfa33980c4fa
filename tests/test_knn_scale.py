"""The kNN search at scale: candidates by matrix products, cells by category, all-against-all in bounded groups; spread input."""

import numpy as np
import pytest

from lendlens.operators import neighbours as N
from lendlens.session import cut_lineage
from lendlens.sources import tables


def _brute(q, x, k, nominal, cost):
    dist = N._distances(q, x, nominal, cost)
    return [[(dist[i, j], j) for j in np.lexsort((np.arange(len(x)), dist[i]))[:k] if np.isfinite(dist[i, j])] for i in range(len(q))]


@pytest.mark.parametrize("gaps,nominal", [(False, 0), (True, 0), (False, 2), (True, 2)])
def test_top_k_is_exact(gaps, nominal):
    rng = np.random.default_rng(3)
    v = np.round(rng.normal(size=(6000, 6)) * [1e6, 1, 1, 1e-3, 1, 1], 2)
    v[:, 4:] = rng.integers(0, 3, size=(6000, 2)) * 1e14 if nominal else v[:, 4:]
    if gaps:
        v[rng.random(v.shape) < 0.2] = np.nan
    q, x = v[:700], v[100:]
    got = N._top_k(np.arange(700), q, np.arange(len(x)), x, 4, nominal, 2.0, np.full(700, np.inf))
    want = _brute(q, x, 4, nominal, 2.0)
    found = {i: list(zip(g["dist"], g["did"])) for i, g in got.groupby("qid")}
    assert [found.get(i, []) for i in range(700)] == want


def test_cells_hold_one_combination_of_categories(spark):
    rng = np.random.default_rng(4)
    rows = [(i, "s", [float(a), float(b) * 1.7e15]) for i, (a, b) in enumerate(zip(rng.normal(size=4000) * 1000, rng.integers(0, 3, 4000)))]
    cells = N._cells(spark.createDataFrame(rows, "did long, space string, vec array<double>"), 2, 100, nominal=1).collect()
    assert all(c["lo"][1] == c["hi"][1] for c in cells)
    assert np.median([c["hi"][0] - c["lo"][0] for c in cells]) < 1500  # of about 7,000: cells are also narrow in the number


@pytest.mark.parametrize("share", [1.0, 0.0])
def test_both_searches_find_the_same(spark, share):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(500, 8)), 1)
    x[rng.random(x.shape) < 0.05] = np.nan
    d = spark.createDataFrame([(i, "s", [float(a) for a in v]) for i, v in enumerate(x)], "did long, space string, vec array<double>")
    got = {}
    for r in N.knn_join(d.withColumnRenamed("did", "qid"), d, 3, max_cell=40, dense_share=share).collect():
        got.setdefault(r["qid"], []).append((r["rank"], r["dist"], r["did"]))
    assert [[t[1:] for t in sorted(got[i])] for i in range(500)] == _brute(x, x, 3, 0, 0.0)


def test_rows_are_dealt_to_all_slots_and_kept_as_columns(spark):
    df = spark.range(1000).coalesce(1).selectExpr("id", "id * 2 AS `a b, c`")
    dealt = tables.spread(df, rows_per_task=10)
    assert dealt.rdd.getNumPartitions() >= max(100, spark.sparkContext.defaultParallelism)
    assert sorted(dealt.collect()) == sorted(df.collect())
    kept = cut_lineage(df.withMetadata("id", {"ml_attr": {"type": "nominal", "num_vals": 3}}))
    assert kept.schema["id"].metadata and sorted(kept.collect()) == sorted(df.collect())
    assert all(f.endswith(".parquet") for f in kept.inputFiles())
